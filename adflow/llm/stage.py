"""Written intermediate tables, samples and training splits of the text operators."""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.session import work_dir


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage: a lost executor costs the running tasks only.
    """
    path = work_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def wrapped(docs: DataFrame, text: str = "text") -> DataFrame:
    """The text as ``t`` and all other columns as the struct ``row``, whatever they are called."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(1).alias("none")]
    return docs.select(F.struct(*others).alias("row"), F.col(f"`{text}`").alias("t"))


def unwrapped(df: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """The columns that ``wrapped`` put together."""
    return df.select(*[F.col("t").alias(c) if c == text else F.col("row")[c].alias(c)
                       for c in columns])


def held_out(key: str, parts: int, rest: int) -> Column:
    """Whether crc32 of the key as text leaves ``rest``; a null key is never held out."""
    own = F.crc32(F.col(key).cast("string").cast("binary")) % parts
    return F.coalesce(own == rest, F.lit(False))


def _known(labels: DataFrame, label: str, parts: int, rest: int, key: str) -> DataFrame:
    return labels.where(
        F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(key, parts, rest)
    ).groupBy(key).agg(F.max(label).cast("int").alias("label"))


def sample_shift(labels: DataFrame, label: str, most: int, parts: int, rest: int,
                 key: str = "doc_id") -> float:
    """What moves log-odds learnt on ``labelled_sample`` to the class shares of all labels that
    it draws from: 0 where it takes all of both classes, or where there is one class only."""
    n = {r["label"]: r["count"] for r in _known(labels, label, parts, rest, key).groupBy(
        "label").count().collect()}
    if len(n) < 2:
        return 0.0
    return log(n[1] / n[0]) - log(min(n[1], most) / min(n[0], most))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, parts: int,
                    rest: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``text`` and ``label`` of at most ``most`` labelled documents of each class.

    They are the first in hash order of those that are not held out, so the sample is the
    same in every run. A document with several labels has the largest; one whose label is
    neither 0 nor 1 has none. Only the sampled ids are broadcast: at most 2 x ``most``.
    """
    known = _known(labels, label, parts, rest, key)
    ones, zeros = (known.where(F.col("label") == v).orderBy(F.xxhash64(key), key).limit(most)
                   for v in (1, 0))
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return texts.join(F.broadcast(ones.union(zeros).withColumnRenamed(key, "key")), "key")
