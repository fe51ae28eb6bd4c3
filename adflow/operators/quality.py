"""Table validation, expectations and column summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adflow.functions.timewin import moment
from adflow.operators.skew import staged
from adflow.sources.sinks import append

SKIPPED_NULL_TYPES = (T.BooleanType, T.StructType, T.DateType)


def date_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))


def _checked_columns(schema: T.StructType) -> list[str]:
    return [
        f.name for f in schema.fields
        if not isinstance(f.dataType, SKIPPED_NULL_TYPES) and "." not in f.name
    ]


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column as one JSON text; booleans, structs and dates are skipped."""
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in _checked_columns(df.schema)]
    return df.agg(*counts).select(F.to_json(F.struct("*")).alias("null_exist_cols"))


def profile(
    df: DataFrame, date_col: str | None = None, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Row count, distinct rows, rows in a period, date range and NULL map, as one row.

    One pass: rows are folded to distinct rows with their counts, and all
    figures are sums over those. The fold is the shuffle that counting distinct
    rows needs anyway; copies of a frequent row are merged before it.
    """
    folded = df.groupBy(*df.columns).agg(F.count("*").alias("__n"))
    n = F.col("__n")

    def rows(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, n)), F.lit(0))

    in_period, low, high = F.lit(0).cast("long"), F.lit(None).cast("string"), F.lit(None).cast("string")
    if date_col is not None:
        day = F.col(date_col)
        low, high = F.min(day).cast("string"), F.max(day).cast("string")
        if start is not None and end is not None:
            kind = df.schema[date_col].dataType
            in_period = rows(day.between(F.lit(start).cast(kind), F.lit(end).cast(kind)))
    nulls = [rows(F.col(c).isNull()).alias(c) for c in _checked_columns(df.schema)]
    return folded.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_count"),
        F.count("*").alias("distinct_count"),
        in_period.alias("period_count"),
        low.alias("min_date"),
        high.alias("max_date"),
        F.to_json(F.struct(*nulls)).alias("null_exist_cols"),
    )


def validate(
    df: DataFrame, database: str, table: str, date_col: str | None, start: str, end: str,
    validated_at: datetime, validated_by: str, is_washing: bool = False,
) -> DataFrame:
    """Profile of one table as a row of the validation result."""
    return profile(df, date_col, start, end).select(
        F.lit(database).alias("database"), F.lit(table).alias("table"), "*",
        F.lit(is_washing).alias("is_washing"), F.lit(f"{start}|{end}").alias("period"),
        moment(validated_at).alias("validated_at"),
        F.lit(validated_by).alias("validated_by"),
    )


def save_validation(rows: DataFrame, table: str) -> None:
    append(rows, table)


def expectations(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows passing and dropping per rule; unknown counts as dropped."""
    passed = [F.count_if(F.expr(rule)).alias(name) for name, rule in rules.items()]
    counts = df.agg(F.count("*").alias("__all"), *passed)
    ledger = F.explode(F.array(*[
        F.struct(
            F.lit(name).alias("rule"), F.col(name).alias("passed"),
            (F.col("__all") - F.col(name)).alias("dropped"),
        )
        for name in rules
    ]))
    return counts.select(ledger.alias("r")).select("r.*")


def observed(df: DataFrame, name: str, rules: Mapping[str, str]) -> tuple[DataFrame, Observation]:
    """The same counts as a side effect of the job that consumes ``df``."""
    watch = Observation(name)
    passed = [F.count_if(F.expr(rule)).alias(rule_name) for rule_name, rule in rules.items()]
    return df.observe(watch, F.count("*").alias("rows"), *passed), watch


SUMMARY = (
    "column", "count", "nulls", "null_share", "min", "max", "mean", "stddev", "p25", "p50", "p75",
)


def summarize(
    df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False, accuracy: int = 10_000
) -> DataFrame:
    """Per column, as rows: count, NULLs and their share, range, mean, deviation, quartiles and
    distinct values.

    Counts, range, mean and deviation come from one pass. Distinct values and quartiles are
    exact: counted column by column, each pass reading its own column, so no row is repeated.
    ``approx=True`` takes both from sketches in the one pass; its quartiles are off by one row
    in ``accuracy`` at most.
    """
    cols = list(cols or df.columns)
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    quarters = (25, 50, 75)

    def stats(c: str) -> list[Column]:
        number = F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
        sketch = F.percentile_approx(number, [q / 100 for q in quarters], accuracy)
        return [
            F.count(c).alias(f"{c}__count"),
            F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
            (F.count_if(F.col(c).isNull()) / F.count("*")).alias(f"{c}__null_share"),
            F.min(c).cast("string").alias(f"{c}__min"),
            F.max(c).cast("string").alias(f"{c}__max"),
            F.avg(number).alias(f"{c}__mean"),
            F.stddev(number).alias(f"{c}__stddev"),
            *[(F.get(sketch, F.lit(i)) if approx else F.lit(None).cast("double")).alias(f"{c}__p{q}")
              for i, q in enumerate(quarters)],
        ]

    one = df.agg(*[s for c in cols for s in stats(c)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{s}").alias(s) for s in SUMMARY[1:]])
        for c in cols
    ]))
    found = one.select(rows.alias("r")).select("r.*")
    if not approx and numeric & set(cols):
        exact = quantiles(df, [c for c in cols if c in numeric], [q / 100 for q in quarters])
        wide = exact.groupBy("column").agg(*[
            F.max(F.when(F.col("share") == q / 100, F.col("value"))).alias(f"p{q}") for q in quarters])
        found = found.drop(*[f"p{q}" for q in quarters]).join(wide, "column", "left").select(*SUMMARY)
    return found.join(distinct_counts(df, cols, approx), "column")


def quantiles(df: DataFrame, cols: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """``column``, ``share``, ``value``: the least value that at least this share of the
    column's values does not exceed, exactly. NULLs do not count; a column without values has
    no rows.

    Selection in three steps. Values fold to counts, which lie sorted in ranges; the counts of
    whole ranges say which range has a wanted rank; only such ranges, one per column and
    share, are added up value by value. No task holds more than a range.
    """
    values = reduce(DataFrame.unionAll, [
        df.where(F.col(c).isNotNull()).select(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
        for c in cols])
    counts = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    ranged = staged(counts.repartitionByRange("column", "value").withColumn(
        "range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("column", "range").agg(F.sum("n").alias("size"))
    ordered = Window.partitionBy("column").orderBy("range")
    placed = sizes.select(
        "column", "range", "size", (F.sum("size").over(ordered) - F.col("size")).alias("before"),
        F.sum("size").over(Window.partitionBy("column")).alias("total"))
    # Whole numbers: the rank of a share is not rounded by floating point.
    wanted = F.explode(F.array(*[F.struct(
        F.lit(float(s)).alias("share"),
        F.greatest(F.ceil(F.col("total") * F.lit(Decimal(str(s)))).cast("long"), F.lit(1).cast("long")).alias("rank"))
        for s in shares]))
    wanted = placed.select("column", "range", "size", "before", wanted.alias("w")).where(
        "w.rank > before AND w.rank <= before + size").select("column", "range", "before", "w.*")
    within = Window.partitionBy("column", "share").orderBy("value")
    return ranged.join(F.broadcast(wanted), ["column", "range"]).withColumn(
        "upto", F.col("before") + F.sum("n").over(within)).where("upto >= rank").groupBy(
        "column", "share").agg(F.min("value").alias("value"))


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """``column`` and ``distinct``: values of each column but NULL."""
    out = None
    for c in cols:
        values = df.select(c)
        one = values.agg(F.approx_count_distinct(c).alias("distinct")) if approx else (
            values.distinct().agg(F.count(c).alias("distinct")))
        one = one.select(F.lit(c).alias("column"), "distinct")
        out = one if out is None else out.unionByName(one)
    return out
