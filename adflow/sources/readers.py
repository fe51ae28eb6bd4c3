"""Batch and streaming sources."""

from __future__ import annotations

import json
from collections.abc import Mapping
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adflow.functions.names import strip_names
from adflow.sources import versions

# Keeps microseconds when times pass through text.
MICROS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def stream_json(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """Stream of (compressed) JSON files under a globbed path. The schema is fixed."""
    reader = spark.readStream.schema(schema).options(**MICROS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def stream_table(spark: SparkSession, name: str) -> DataFrame:
    return versions.stream(spark, name)


def stream_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines. Without a schema Spark reads the data twice to infer one."""
    reader = spark.read.options(**MICROS)
    return (reader.schema(schema) if schema else reader).json(path)


def read_partitions(
    spark: SparkSession, base: str, year: str, month: str, day: str = "*", hour: str = "*"
) -> DataFrame:
    """Hive-style ``year=/month=/day=/hour=`` folders; parts may be globs."""
    path = f"{base}/year={year}/month={month}/day={day}/hour={hour}"
    return spark.read.option("basePath", base).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line; blanks are taken out of the column names."""
    reader = spark.read.option("header", True).options(**MICROS)
    return strip_names((reader.schema(schema) if schema else reader).csv(path))


def jdbc_options(
    url: str, table: str | None = None, query: str | None = None,
    props: Mapping[str, str] | None = None, partition: tuple[str, int, int, int] | None = None,
) -> dict[str, str]:
    """Reader options for a table, or for a query the database runs itself.

    ``partition`` is (column, lower, upper, number): that many connections each
    read a stripe. Stripes go with a table, not with a query.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, **(props or {})}
    options["dbtable" if table else "query"] = table or query
    if partition:
        if query:
            raise ValueError("a query cannot be read in stripes")
        column, lower, upper, number = partition
        options.update(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper),
            numPartitions=str(number),
        )
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def clean_dimension(
    df: DataFrame, encoded: tuple[str, ...] = ("Name",), flags: tuple[str, ...] = ("DelYN",),
    times: tuple[str, ...] = ("StartTime", "EndTime"),
) -> DataFrame:
    """Dimension rows of the booking database: decode names, flags to int, clock times."""
    from adflow.functions.scalars import decode_base64
    from adflow.functions.timewin import clock_time

    changes = {
        **{c: decode_base64(F.col(c)) for c in encoded if c in df.columns},
        **{c: F.col(c).cast("int") for c in flags if c in df.columns},
        **{c: clock_time(F.col(c)) for c in times if c in df.columns},
    }
    return df.withColumns(changes)


def read_window(spark: SparkSession, table: str, date_col: str, start: str, end: str) -> DataFrame:
    """Rows of a table whose date lies in ``[start, end]``.

    The bounds take the column's type, so the predicate stays on the bare
    column and prunes partitions.
    """
    df = spark.table(table)
    kind = df.schema[date_col].dataType
    low, high = (F.lit(v).cast(kind) for v in (start, end))
    return df.where(F.col(date_col).between(low, high))


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed report rows of one channel."""
    return spark.read.schema(schema).json(path)


def read_ga4(spark: SparkSession, daily: str, intraday: str | None = None) -> DataFrame:
    """Web analytics export: closed days plus the running day."""
    df = spark.table(daily)
    return df.unionByName(spark.table(intraday)) if intraday else df


def load_query(spark: SparkSession, name: str, **args) -> DataFrame:
    """Run a packaged SQL file by name; values are bound, not pasted in."""
    text = resources.files("adflow").joinpath(f"sql/{name}.sql").read_text(encoding="utf-8")
    return spark.sql(text, args=args)


def drop_all_null(df: DataFrame) -> DataFrame:
    """Without rows and columns that hold nothing but NULL, as spreadsheets often do.

    One aggregate row decides about the columns.
    """
    counts = df.agg(*[F.count(f"`{c}`").alias(c) for c in df.columns]).first()
    return df.select(*[f"`{c}`" for c in df.columns if counts[c]]).dropna("all")


def freeze_schema(df: DataFrame, path: str) -> None:
    """Store a schema as JSON text on shared storage."""
    row = df.sparkSession.createDataFrame([(df.schema.json(),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.text(path).first()["value"]))


def schema_from_properties(rows: list[tuple[str, str]]) -> T.StructType:
    """Schema from (name, type text) pairs, e.g. a property file."""
    return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in rows))
