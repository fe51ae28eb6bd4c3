"""Time-bucket statistics, counts, profiles and top lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.functions.timewin import time_bucket
from adflow.operators.funnel import STAT_DIMS


def rollup_bucket(
    df: DataFrame, ts: str, minutes: int, dims: Sequence[str], price: str | None = None
) -> DataFrame:
    """Rows (and price) per time bucket and dimension set."""
    aggs = [F.count("*").alias("cnt")]
    if price:
        aggs.append(F.sum(price).alias("price_sum"))
    bucket = time_bucket(F.col(ts), minutes).alias("bucket")
    return df.groupBy(bucket, *dims).agg(*aggs)


def stat(funnel: DataFrame, dims: Sequence[str] = STAT_DIMS) -> DataFrame:
    """Bids, impressions, clicks and revenue of funnel rows, per ``Date`` and dimensions."""
    names = {"AdExchangeTypes": "ExchangeTypes"}
    return funnel.groupBy(
        "Date", *[F.col(d).alias(names.get(d, d)) for d in dims]
    ).agg(
        F.count("bidtime").alias("bid"),
        F.count("imptime").alias("imp"),
        F.count("clktime").alias("clk"),
        F.coalesce(F.sum("Revenue"), F.lit(0).cast("decimal(23,10)")).alias("Revenue"),
    )


def rollup_day(hourly_or_rows: DataFrame, dims: Sequence[str] = STAT_DIMS) -> DataFrame:
    """Daily statistic straight from funnel rows."""
    return stat(hourly_or_rows.withColumn("Date", F.to_date("Date")), dims)


def rollup_up(stats: DataFrame, minutes: int) -> DataFrame:
    """Coarser statistic out of a finer one (5 minutes to hours, hours to days)."""
    measures = ("bid", "imp", "clk", "Revenue")
    dims = [c for c in stats.columns if c not in ("Date", *measures)]
    return stats.groupBy(time_bucket(F.col("Date"), minutes).alias("Date"), *dims).agg(
        *[F.sum(m).alias(m) for m in measures]
    )


def count_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


def price_profile(df: DataFrame, key: str, bid: str = "bid_price", win: str = "win_price") -> DataFrame:
    """Sum, mean and count of bid and win price per key, also per thousand (CPM).

    Means come from the exact sums, so the answer does not depend on row order.
    """
    sums = df.groupBy(key).agg(
        F.sum(bid).alias("__b"), F.count(bid).alias("cnt_bid_price"),
        F.sum(win).alias("__w"), F.count(win).alias("cnt_win_price"),
    )
    b, w = F.col("__b").cast("double"), F.col("__w").cast("double")
    mean_w = F.try_divide(w, F.col("cnt_win_price"))
    return sums.select(
        key,
        b.alias("sum_bid_price"),
        F.try_divide(b, F.col("cnt_bid_price")).alias("avg_bid_price"),
        "cnt_bid_price",
        w.alias("sum_win_price"),
        mean_w.alias("avg_win_price"),
        (F.col("__w") * 1000).cast("double").alias("sum_win_cpm"),
        (mean_w * 1000).alias("avg_win_cpm"),
    )


def zero_split(df: DataFrame, price: str) -> DataFrame:
    """Count and sum of zero-priced against priced rows, in one pass.

    NULL prices belong to neither group.
    """
    is_zero = (F.col(price) == 0).alias("is_zero")
    return (
        df.where(F.col(price).isNotNull())
        .groupBy(is_zero)
        .agg(F.count("*").alias("cnt"), F.sum(price).alias("price_sum"))
    )


def distinct_of(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def sum_positive(df: DataFrame, keys: Sequence[str], metric: str) -> DataFrame:
    """Sum per key, groups above zero only."""
    return df.groupBy(*keys).agg(F.sum(metric).alias(metric)).where(F.col(metric) > 0)


def sum_by(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in metrics])


def cardinality(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct values per string column, one row.

    The exact form counts column by column in two steps, each reading its own column;
    ``approx=True`` keeps one sketch per column in a single pass.
    """
    cols = list(cols or [f.name for f in df.schema.fields if f.dataType.typeName() == "string"])
    if approx:
        return df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
    counts = [df.select(c).distinct().agg(F.count(c).alias("n")).scalar().alias(c) for c in cols]
    return df.sparkSession.range(1).select(*counts)


def label_counts(df: DataFrame, label: str) -> DataFrame:
    return count_by(df, [label])


def ratio_by(df: DataFrame, key: Column | str, name: str | None = None) -> DataFrame:
    """Rows per value and their share of all rows, in percent.

    The total is a scalar subquery that sums the groups, not a window over one
    partition, so a column with very many values stays distributed and the grouping is
    reused.
    """
    name = name or (key if isinstance(key, str) else "value")
    column = F.col(key) if isinstance(key, str) else key
    groups = df.groupBy(column.alias(name)).agg(F.count("*").alias("cnt"))
    total = groups.select(F.sum("cnt").alias("n")).scalar()
    return groups.withColumn("ratio", F.col("cnt") / total * 100)


def top_k(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The ``k`` values with most rows; equal counts in key order."""
    return (
        df.groupBy(key)
        .agg(F.count(key).alias("cnt"))
        .orderBy(F.desc("cnt"), F.asc(key))
        .limit(k)
    )


def latest(df: DataFrame, ts: str, *ties: str) -> DataFrame:
    """The newest row."""
    return df.orderBy(F.desc(ts), *[F.desc(t) for t in ties]).limit(1)


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)
