"""Column names and column sets of report tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def camel(name: str) -> str:
    """``metrics_cost_micros`` -> ``metricsCostMicros``; the first word stays as it is."""
    first, *rest = name.split("_")
    return first + "".join(word.title() for word in rest)


def snake(name: str) -> str:
    """``metricsCostMicros`` -> ``metrics_cost_micros``; runs of capitals stay together."""
    words = re.sub(r"(.)([A-Z][a-z]+)", r"\1_\2", name)
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", words).lower()


def _renamed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """All columns at once: one projection, however many columns change."""
    taken = sorted({n for n in names if list(names).count(n) > 1})
    if taken:
        raise ValueError(f"renaming makes names collide: {taken}")
    return df.toDF(*names)


def snake_to_camel(df: DataFrame) -> DataFrame:
    return _renamed(df, [camel(c) for c in df.columns])


def camel_to_snake(df: DataFrame) -> DataFrame:
    return _renamed(df, [snake(c) for c in df.columns])


# Prefix rules of the dotted report formats: text to replace, in order.
DOTTED_RULES = (("metrics.", "metrics_"), ("dimensions.", ""), (".", "_"))


def normalize_names(
    df: DataFrame, rules: Sequence[tuple[str, str]] = DOTTED_RULES
) -> DataFrame:
    """Dotted names (``metrics.cost_sum``) to camel case (``metricsCostSum``)."""
    out = []
    for name in df.columns:
        for old, new in rules:
            name = name.replace(old, new)
        out.append(camel(name))
    return _renamed(df, out)


def rename_map(df: DataFrame, mapping: Mapping[str, str], only: bool = False) -> DataFrame:
    """Rename by table, e.g. report headers in another language. ``only`` drops the rest."""
    if only:
        return df.select(*[F.col(f"`{old}`").alias(new) for old, new in mapping.items()])
    return df.withColumnsRenamed(dict(mapping))


def strip_names(df: DataFrame) -> DataFrame:
    return _renamed(df, [c.replace(" ", "") for c in df.columns])


def drop_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def stamp(df: DataFrame, **constants) -> DataFrame:
    """Constant columns such as the account name or the day of a wash run."""
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def select_regex(df: DataFrame, pattern: str) -> DataFrame:
    return df.select(df.colRegex(f"`{pattern}`"))


def add_null_cols(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` the frame lacks, as typed NULLs."""
    missing = [f for f in schema.fields if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def null_types_to_string(df: DataFrame) -> DataFrame:
    """Columns that hold nothing but NULL have no storable type; make them strings."""
    return df.withColumns({
        f.name: F.col(f.name).cast("string")
        for f in df.schema.fields
        if isinstance(f.dataType, T.NullType)
    })


def leaves(schema: T.StructType, path: str = "", sep: str = "_") -> list[tuple[str, str]]:
    """Dotted path and flat name (``a_b``) of every non-struct field."""
    out = []
    for field in schema.fields:
        full = f"{path}.{field.name}" if path else field.name
        if isinstance(field.dataType, T.StructType):
            out += leaves(field.dataType, full, sep)
        else:
            out.append((full, full.replace(".", sep)))
    return out


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    return df.select(*[F.col(path).alias(name) for path, name in leaves(df.schema, sep=sep)])


def normalize(df: DataFrame, record_path: str, meta: Sequence[str]) -> DataFrame:
    """One flat row per element of the array at ``record_path``, with parent columns.

    Parents with an empty or missing array give no row.
    """
    rows = df.select(*meta, F.explode(record_path).alias("__r"))
    return flatten(rows.select(*meta, "__r.*"))


def propagate(
    child: DataFrame, parent: DataFrame, key: str, columns: Mapping[str, str]
) -> DataFrame:
    """Carry parent attributes (``{parent column: new name}``) onto the children."""
    carried = parent.select(key, *[F.col(c).alias(n) for c, n in columns.items()])
    return child.join(carried, key)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Shape rows to a target: extra columns dropped, missing ones NULL, types cast."""

    def column(field: T.StructField) -> Column:
        if field.name in df.columns:
            return F.col(field.name).cast(field.dataType).alias(field.name)
        return F.lit(None).cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def fill_metrics(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL numbers become 0."""
    return df.fillna(0, subset=list(cols) if cols else None)
