"""Joins in which a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.session import work_dir

# A key with at least this share of the rows counts as frequent; so there are
# never more than 1 / SHARE of them.
SHARE = 0.001
SALTS = 64


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a costly frame to the shared folder once and read it from there.

    Cuts the lineage too: a lost executor does not send the job back to the start.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def key_hash(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> Column:
    """Hash of the key tuple, equal on both frames even if key types differ."""
    parts = [
        F.col(k) if df.schema[k].dataType == other.schema[k].dataType else F.col(k).cast("string")
        for k in keys
    ]
    return F.xxhash64(*parts)


def _not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for key in keys:
        cond = cond & F.col(key).isNotNull()
    return cond


def frequent(df: DataFrame, keys: Sequence[str], value: Column, share: float = SHARE) -> list[int]:
    """Hashes of the frequent keys, by a heavy-hitter sketch.

    One pass over the key columns; each task keeps a sketch of fixed size and
    nothing is shuffled by key. At most ``1 / share`` numbers come back. The
    counts are estimates, which is enough: the list decides how rows are spread,
    never which rows there are.
    """
    limit = int(1 / share)
    row = df.where(_not_null(keys)).select(value.alias("h")).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(h, {limit}, {limit * 10})").alias("top")
    ).first()
    return [t["item"] for t in row["top"] or [] if t["count"] >= share * row["n"]]


def _spread(df: DataFrame, cond: Column, salts: int) -> DataFrame:
    """Number rows under ``cond`` by a hash of the row, all others 0."""
    number = F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int")
    return df.withColumn("__salt", F.when(cond, number).otherwise(0))


def _repeat(df: DataFrame, cond: Column, salts: int) -> DataFrame:
    """Repeat rows under ``cond`` once per number."""
    copies = F.when(cond, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("__salt", F.explode(copies))


def skew_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
    salts: int = SALTS, share: float = SHARE,
) -> DataFrame:
    """Equi-join that spreads each frequent left key over ``salts`` tasks.

    The right rows of those keys are repeated once per salt; other keys are
    neither salted nor repeated. NULL keys match nothing and are spread as well.
    Meant for a right side with few rows per key (a dimension). Whether that side
    is broadcast is left to the optimizer and to adaptive execution.

    The left side is read twice: pass a table, or a frame that is ``staged``.
    """
    if how not in ("left", "inner"):
        raise ValueError("only left and inner joins can be salted on the left side")
    keys = list(keys)
    hashed = key_hash(left, right, keys)
    hot = frequent(left, keys, hashed, share)
    l = _spread(left, hashed.isin(hot) | ~_not_null(keys), salts)
    r = _repeat(right.where(_not_null(keys)), hashed.isin(hot), salts)
    return l.join(r, [*keys, "__salt"], how).drop("__salt")


def fanout_left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], salts: int = SALTS,
    share: float = SHARE,
) -> DataFrame:
    """Left join whose right side has frequent keys; every match is kept.

    The optimizer cannot split the right side of a left join. So frequent keys
    are taken out: their matches are an inner join with the right rows spread
    over ``salts`` tasks and the left rows repeated; left rows of theirs without
    a match follow by an anti join. Left rows with a NULL key match nothing and are
    spread over the tasks by a salt of their own. Both sides are staged, as they are
    read more than once. Meant for a left side with few rows per key.
    """
    keys = list(keys)
    right = staged(right.where(_not_null(keys)), "fanout-right")
    hashed = key_hash(left, right, keys)
    hot = frequent(right, keys, hashed, share)
    if hot:
        left = staged(left, "fanout-left")
    is_hot = F.coalesce(hashed.isin(hot), F.lit(False)) & _not_null(keys)
    l, r = _spread(left.where(~is_hot), ~_not_null(keys), salts), right.where(~is_hot)
    # Always 0, but not a literal: the planner would take a literal out of the join keys.
    zero = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")
    cold = l.join(r.withColumn("__salt", zero), [*keys, "__salt"], "left").drop("__salt")
    if not hot:
        return cold
    l, r = left.where(is_hot), right.where(is_hot)
    every = F.lit(True)
    matched = _repeat(l, every, salts).join(_spread(r, every, salts), [*keys, "__salt"]).drop("__salt")
    alone = l.join(r.select(*keys).distinct(), keys, "left_anti")
    return cold.unionByName(matched).unionByName(alone, allowMissingColumns=True)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail when a key tuple occurs twice, naming one."""
    twice = df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1").head()
    if twice is not None:
        raise ValueError(f"not unique on {list(keys)}: {twice}")
