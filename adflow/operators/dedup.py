"""One row per key, and inspection of keys that have more."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row of each key in ``order``.

    Written as ``row_number() = 1``: Spark then plans a group limit on the map
    side, so each task ships one row per key at most, however many rows a hot
    key has. ``order`` has to be a total order for a repeatable answer.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rank).where("__rn = 1").drop("__rn")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedup_on(df: DataFrame, prefix: str, order: Sequence[str | Column]) -> DataFrame:
    """One row per distinct set of the columns whose name contains ``prefix``.

    Two different ads with equal numbers collapse into one row. That is how the
    report it serves is defined; ``order`` decides which one stays.
    """
    keys = [c for c in df.columns if prefix in c]
    return first_by(df, keys, order)


def dup_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(key).agg(F.count("*").alias("rows")).where("rows > 1")


def dup_report(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Distinct attribute tuples of the duplicated keys.

    Counted first and joined back on the few tuples left, so that a key with
    very many rows is folded before it is shuffled.
    """
    tuples = df.groupBy(key, *attributes).agg(F.count("*").alias("tuple_rows"))
    totals = (
        tuples.groupBy(key)
        .agg(F.sum("tuple_rows").alias("rows"), F.count("*").alias("variants"))
        .where("rows > 1")
    )
    return tuples.join(totals, key).select(key, *attributes, "tuple_rows", "rows", "variants")
