"""Writes that can be repeated without changing the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from adflow.sources import versions as vs


def append(
    df: DataFrame, table: str, partition_by: Sequence[str] = (), widen: bool = False
) -> None:
    """Add rows to a table, or make it. Columns go by name; a column that the table lacks is an
    error, or with ``widen`` a new column of the table."""
    spark = df.sparkSession
    vs.recover(spark, table)
    if not spark.catalog.tableExists(table):
        overwrite(df, table, partition_by)
    elif vs.pointer(spark, table):
        vs.add(df, table, widen=widen)
    else:
        _take_over(spark.table(table), df, table, widen)


def _take_over(kept: DataFrame, new: DataFrame, table: str, widen: bool) -> None:
    """A table that someone else made becomes a versioned one with its first change here: all of
    it is written once."""
    rows = kept.unionByName(new, allowMissingColumns=widen)
    vs.replace_all(rows, table, partition_columns(kept.sparkSession, table))


def overwrite(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """New content for a table, or a new table: shown by one statement when all files are
    complete, so a failed run leaves the table as it was. ``df`` may read the table."""
    vs.replace_all(df, table, partition_by)


def refresh_dim(df: DataFrame, table: str) -> None:
    """Full refresh of a dimension, in one write."""
    overwrite(df, table)


def export_parquet(df: DataFrame, base: str, date: str, hour: str | None = None) -> str:
    """Write to a dated folder and return its path."""
    path = f"{base}/{date}" + (f"/{hour}" if hour is not None else "")
    df.write.mode("overwrite").parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Partitioned files; partitions present in ``df`` replace their old content."""
    (
        vs.sized(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_sized(df: DataFrame, path: str, rows_per_file: int) -> None:
    """Files of a bounded number of rows, without tiny ones."""
    df.hint("rebalance").write.mode("overwrite").option(
        "maxRecordsPerFile", rows_per_file
    ).parquet(path)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    own = vs.pointer(spark, table)
    if own:
        return own.parts
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def partitions(spark: SparkSession, table: str) -> DataFrame:
    """The table's partitions, as rows of its partition columns."""
    own = vs.pointer(spark, table)
    if own:
        return vs.live(spark, own).select(*own.parts).distinct()
    return spark.table(table).select(*partition_columns(spark, table)).distinct()


def _one_of(parts: Sequence[str], values: Sequence[Row]) -> Column:
    """Partition predicate as literals, which prunes the file listing."""
    if len(parts) == 1 and all(v[0] is not None for v in values):
        return F.col(parts[0]).isin([v[0] for v in values])
    matches = [
        reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.lit(v[p])) for p in parts])
        for v in values
    ]
    return reduce(lambda a, b: a | b, matches)


def _only(cond: Column, columns: DataFrame) -> bool:
    """Whether a predicate needs no more than these columns."""
    try:
        columns.where(cond)
    except AnalysisException:
        return False
    return True


def replace_window(
    new: DataFrame, table: str, window: Column, scope: Mapping[str, object] | None = None,
    widen: bool = False,
) -> None:
    """Delete the rows of a window (and scope), then add ``new``, in one change.

    The window need not match partition bounds. Partitions that lose rows are written anew, as
    their surviving rows plus the new ones; partitions that only gain rows get files more.
    Rows for which the predicate is unknown (NULL) survive. A window over partition columns
    alone is answered by the list of partitions: they go whole, unread. ``new`` is computed
    once and may read the table. ``widen`` as in ``append``.
    """
    spark = new.sparkSession
    vs.recover(spark, table)
    target, parts = spark.table(table), partition_columns(spark, table)
    doomed = window
    for name, value in (scope or {}).items():
        doomed = doomed & (F.col(name) == F.lit(value))
    survives = ~F.coalesce(doomed, F.lit(False))
    if vs.pointer(spark, table) is None:
        _take_over(target.where(survives), new, table, widen)
        return
    if not parts:
        rows = target.where(survives).unionByName(new, allowMissingColumns=widen)
        vs.add(rows, table, gone=target.limit(0), widen=widen)
        return
    schema, kept = target.select(*parts).schema, None
    if _only(doomed, spark.createDataFrame([], schema)):
        gone = partitions(spark, table).where(doomed)
    else:
        # As many values as the window has partitions.
        found = target.where(doomed).select(*parts).distinct().collect()
        gone = spark.createDataFrame(found, schema)
        kept = target.where(_one_of(parts, found)).where(survives) if found else None
    rows = kept.unionByName(new, allowMissingColumns=widen) if kept is not None else new
    vs.add(rows, table, gone=gone, widen=widen)


def save_features(df: DataFrame, table: str) -> None:
    """Feature rows as a table; vector columns keep their type."""
    overwrite(df, table)
