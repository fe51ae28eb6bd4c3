"""Running a job again over past dates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adflow.functions.timewin import moment
from adflow.operators.quality import save_validation, validate
from adflow.sources.sinks import overwrite, replace_window

Job = Callable[[datetime, datetime], DataFrame]


def intervals(start: datetime, end: datetime, by: str) -> list[tuple[datetime, datetime]]:
    """The half-open range whole, or cut into days."""
    if by == "interval":
        return [(start, end)]
    if by == "day":
        days = (end - start).days
        return [(start + timedelta(days=i), start + timedelta(days=i + 1)) for i in range(days)]
    raise ValueError(f"unknown step {by!r}")


def wash(
    spark: SparkSession, job: Job, table: str, date_col: str, start: datetime, end: datetime,
    by: str = "interval", scope: Mapping[str, object] | None = None,
    runs: str | None = None, run_by: str = "adflow", as_of: datetime | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Recompute ``[start, end)``, replace it in the table, and validate the result.

    The window replaced is the window computed, so a second run changes nothing. With
    ``by="day"`` the job runs per day, and all days are replaced in one change. A missing
    table is made with partitions by ``partition_by``, so that later runs rewrite days only.
    Returns the validation row; it is also appended to ``runs`` when given.
    """
    spans = intervals(start, end, by)
    rows = reduce(lambda a, b: a.unionByName(b), [job(low, high) for low, high in spans])
    if not spark.catalog.tableExists(table):
        overwrite(rows, table, partition_by)
    else:
        kind = spark.table(table).schema[date_col].dataType
        window = (F.col(date_col) >= moment(start).cast(kind)) & (
            F.col(date_col) < moment(end).cast(kind)
        )
        if kind.typeName() == "string":
            window = (F.col(date_col) >= start.strftime("%Y-%m-%d")) & (
                F.col(date_col) < end.strftime("%Y-%m-%d")
            )
        replace_window(rows, table, window, scope)
    database, _, name = table.rpartition(".")
    last = end - timedelta(days=1)
    result = validate(
        spark.table(table), database, name, date_col,
        start.strftime("%Y-%m-%d"), last.strftime("%Y-%m-%d"),
        as_of or end, run_by, is_washing=True,
    )
    if runs:
        save_validation(result, runs)
        return spark.table(runs)
    return result
