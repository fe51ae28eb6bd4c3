"""Finding, comparing, cloning and re-laying out tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adflow.functions.names import leaves
from adflow.sources import versions as vs
from adflow.sources.sinks import overwrite, partition_columns

DEV_PREFIX = "tt_"
DATE_WORDS = ("date", "Date", "start")


def list_tables(spark: SparkSession, databases: Sequence[str]) -> list[tuple[str, str]]:
    """(database, table) of every table that is not a view.

    A versioned table counts as one, by its name; the tables behind it do not.
    """
    out = set()
    for db in databases:
        for t in spark.catalog.listTables(db):
            base = vs.base_name(t.name)
            if base is not None:
                out.add((db, base))
            elif t.tableType != "VIEW" and not t.isTemporary:
                out.add((db, t.name))
    return sorted(out)


def find_tables(
    spark: SparkSession, database: str, mode: str, names: Sequence[str]
) -> list[str]:
    """Tables by full name, by part of the name (dev copies excluded), or by pattern."""
    tables = [t for _, t in list_tables(spark, [database])]
    if mode == "full":
        return [t for t in tables if t in set(names)]
    if mode == "contains":
        return [
            t for t in tables
            if any(n in t for n in names) and DEV_PREFIX not in t
        ]
    if mode == "regex":
        return [t for t in tables if any(re.search(n, t) for n in names)]
    raise ValueError(f"unknown mode {mode!r}")


def detect_date_col(schema: T.StructType) -> str | None:
    """First column named like a date whose type can hold one."""
    kinds = (T.DateType, T.StringType, T.TimestampType, T.TimestampNTZType)
    for field in schema.fields:
        named = field.name.startswith(DATE_WORDS) or field.name.endswith(DATE_WORDS)
        if named and isinstance(field.dataType, kinds):
            return field.name
    return None


DIFF_SCHEMA = "table string, column string, left string, right string"


def diff_schemas(left: T.StructType, right: T.StructType) -> list[tuple[str, str | None, str | None]]:
    """(leaf path, left type, right type) of the leaves that differ."""

    def types(schema: T.StructType) -> dict[str, str]:
        out = {}
        for path, _ in leaves(schema):
            node: T.DataType = schema
            for step in path.split("."):
                node = node[step].dataType
            out[path] = node.simpleString()
        return out

    a, b = types(left), types(right)
    paths = [*a, *[p for p in b if p not in a]]
    return [(p, a.get(p), b.get(p)) for p in paths if a.get(p) != b.get(p)]


def schema_diff(spark: SparkSession, left_db: str, right_db: str) -> DataFrame:
    """Columns that differ between tables of the same name; one-sided tables too."""
    left = {t for _, t in list_tables(spark, [left_db])}
    right = {t for _, t in list_tables(spark, [right_db])}
    rows: list[tuple] = []
    for table in sorted(left | right):
        if table not in left or table not in right:
            present = ("present", None) if table in left else (None, "present")
            rows.append((table, "*", *present))
            continue
        pair = (spark.table(f"{db}.{table}").schema for db in (left_db, right_db))
        rows += [(table, *d) for d in diff_schemas(*pair)]
    return spark.createDataFrame(rows, DIFF_SCHEMA)


def clone_table(spark: SparkSession, source: str, target: str) -> None:
    """Copy a table with its partitioning."""
    parts = partition_columns(spark, source)
    clause = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
    spark.sql(f"CREATE TABLE {target} USING parquet {clause} AS SELECT * FROM {source}")


def clone_tables(
    spark: SparkSession, source_db: str, target_db: str, names: Sequence[str]
) -> DataFrame:
    """Copy tables to another database; rows copied per table."""
    out = None
    for name in names:
        clone_table(spark, f"{source_db}.{name}", f"{target_db}.{name}")
        count = spark.table(f"{target_db}.{name}").select(
            F.lit(name).alias("table"), F.lit(1).alias("one")
        ).groupBy("table").agg(F.count("one").alias("rows"))
        out = count if out is None else out.unionByName(count)
    return out


def sync_dev(spark: SparkSession, database: str, dev_database: str) -> DataFrame:
    """Re-clone dev tables whose schema left the production one; rows copied."""
    diff = schema_diff(spark, database, dev_database)
    stale = sorted({r["table"] for r in diff.collect()})
    source = {t for _, t in list_tables(spark, [database])}
    for name in stale:
        vs.remove(spark, f"{dev_database}.{name}")
    return clone_tables(spark, database, dev_database, [n for n in stale if n in source])


def table_inventory(spark: SparkSession, database: str, names: Sequence[str]) -> DataFrame:
    """Row count per table."""
    out = None
    for name in names:
        count = spark.table(f"{database}.{name}").agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table"), "rows"
        )
        out = count if out is None else out.unionByName(count)
    return out


def partition_tables(
    spark: SparkSession, database: str, names: Sequence[str], row_threshold: int
) -> list[str]:
    """Rewrite large tables partitioned by day; names of those changed.

    A date column is the partition column itself; of a timestamp the day is, in a column
    ``<name>_day``, as its own values would make a folder each. So is the first ten
    characters' date of a text. Tables without a date column, already partitioned ones, and
    those below the threshold stay.
    """
    changed = []
    for name in names:
        full = f"{database}.{name}"
        df = spark.table(full)
        day = detect_date_col(df.schema)
        if day is None or partition_columns(spark, full) or df.count() < row_threshold:
            continue
        part = day
        if not isinstance(df.schema[day].dataType, T.DateType):
            part = f"{day}_day"
            df = df.withColumn(part, F.to_date(F.substring(F.col(day).cast("string"), 1, 10)))
        _swap_in(df, database, name, [part])
        changed.append(name)
    return changed


def _swap_in(df: DataFrame, database: str, name: str, parts: Sequence[str]) -> None:
    """Put ``df``, which may read the table, in the table's place."""
    overwrite(df, f"{database}.{name}", parts)


def alter_nested(df: DataFrame, path: str, kind: str) -> DataFrame:
    """Change the type of a field inside structs (``a.b.c``)."""
    root, rest = path.split(".", 1)
    return df.withColumn(root, F.col(root).withField(rest, F.col(path).cast(kind)))


def cast_in_array(df: DataFrame, array_col: str, field: str, kind: str) -> DataFrame:
    """Change the type of a field of the structs in an array."""

    def change(item: Column) -> Column:
        return item.withField(field, item[field].cast(kind))

    return df.withColumn(array_col, F.transform(array_col, change))


def alter_column(spark: SparkSession, table: str, column: str, kind: str) -> None:
    """Change a column's type by a staged rewrite."""
    database, name = table.split(".")
    parts = partition_columns(spark, table)
    changed = spark.table(table).withColumn(column, F.col(column).cast(kind))
    _swap_in(changed, database, name, parts)


def read_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files whose schema grew over time."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def create_like(spark: SparkSession, source: str, target: str) -> None:
    """Empty table with another one's schema."""
    spark.createDataFrame([], spark.table(source).schema).write.saveAsTable(target)


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per partition of the frame."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))


def partition_values(df: DataFrame, column: str) -> DataFrame:
    """Rows per partition and value: where a value's rows lie, as rows, not lists."""
    return df.groupBy(F.spark_partition_id().alias("partition"), column).agg(
        F.count("*").alias("rows")
    )
