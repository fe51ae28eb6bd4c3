"""Row filters of the stat, report and training jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the device id of users who opted out of tracking.
ZERO_DEVICE = "00000000-0000-0000-0000-000000000000"


def in_list(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(*values))


def in_table(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """``in_list`` for lists too long for query text: a one-column frame."""
    keys = values.select(F.col(values.columns[0]).alias(column))
    return df.join(keys, column, "left_semi")


def known_device(df: DataFrame, column: str = "DeviceId") -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.col(column) != ZERO_DEVICE))


def where_positive(df: DataFrame, metric: str) -> DataFrame:
    return df.where(F.col(metric) > 0)


def valid_funnel(df: DataFrame, imp: str = "imp", clk: str = "clk") -> DataFrame:
    """Rows whose flags follow the event order: no click without an impression."""
    i, c = F.col(imp), F.col(clk)
    return df.where(((i == "0") & (c == "0")) | (i == "1") & c.isin("0", "1"))


def invalid_codes(df: DataFrame, column: str, valid: Sequence) -> DataFrame:
    """Rows per code outside the valid set."""
    outside = df.where(~F.col(column).isin(*valid))
    return outside.groupBy(column).agg(F.count("*").alias("cnt"))


def report_filter(df: DataFrame, **equal) -> DataFrame:
    """Keep rows by status, type or enabled flag; a list means any of them."""
    for name, value in equal.items():
        values = value if isinstance(value, (list, tuple, set)) else [value]
        df = in_list(df, name, list(values))
    return df


def like(df: DataFrame, column: str, want: str | None = None, avoid: str | None = None) -> DataFrame:
    if want is not None:
        df = df.where(F.col(column).like(want))
    if avoid is not None:
        df = df.where(~F.col(column).like(avoid))
    return df


def id_type(df: DataFrame, column: str = "id_type", kind: str = "ADID") -> DataFrame:
    return df.where(F.col(column) == kind)
