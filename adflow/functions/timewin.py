"""Time buckets on rows, and half-open windows for scheduled jobs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KST = "Asia/Seoul"


def time_bucket(ts: Column, minutes: int) -> Column:
    """Start of the bucket holding ``ts``, in the type of ``ts``.

    ``minutes`` divides an hour, or is 60 or 1440. Unlike ``window()`` it keeps
    rows whose time is NULL, and unlike ``date_trunc`` it leaves times without a
    zone alone, so the session's zone plays no part.
    """
    if minutes not in (60, 1440) and (minutes <= 0 or 60 % minutes):
        raise ValueError(f"bucket of {minutes} minutes does not divide an hour")
    hours = F.hour(ts) if minutes == 1440 else F.lit(0)
    past = F.minute(ts) % F.lit(min(minutes, 60))
    return ts - F.make_dt_interval(F.lit(0), hours, past, F.extract(F.lit("SECOND"), ts))


def hour_of(ts: Column) -> Column:
    return time_bucket(ts, 60)


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def between_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``; negative when the order is wrong."""
    return F.timestamp_diff("SECOND", start, end)


def clock_time(ts: Column) -> Column:
    """``HH:mm:ss`` of a timestamp.

    The pattern ``HH:mm:SS`` seen in older jobs prints fractions of a second in
    the last field; this one prints seconds.
    """
    return F.date_format(ts, "HH:mm:ss")


def moment(t: datetime) -> Column:
    """Literal without a zone. A datetime literal would take the machine's zone."""
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


@dataclass(frozen=True)
class Window:
    """Half-open time range ``[start, end)``."""

    start: datetime
    end: datetime

    def holds(self, ts: Column) -> Column:
        """Range predicate a Parquet scan can use, unlike one on a function of ``ts``."""
        return (ts >= moment(self.start)) & (ts < moment(self.end))

    def holds_date(self, day: Column) -> Column:
        return (day >= F.lit(self.start.date())) & (day < F.lit(self.end.date()))

    @property
    def first_day(self) -> str:
        return self.start.strftime("%Y-%m-%d")

    @property
    def last_day(self) -> str:
        return (self.end - timedelta(microseconds=1)).strftime("%Y-%m-%d")


def local_now(utc_now: datetime, hours: int = 9) -> datetime:
    """Wall clock of the reports' zone from a UTC clock."""
    return utc_now + timedelta(hours=hours)


def _month_start(t: datetime, back: int = 0) -> datetime:
    months = t.year * 12 + t.month - 1 - back
    return datetime(months // 12, months % 12 + 1, 1)


def criteria(as_of: datetime, grain: str) -> Window:
    """Last complete window of a scheduled job run at ``as_of`` (local time).

    5m: at :33 the bucket :25-:30; 1h: the previous hour; 1d: yesterday.
    """
    if grain == "5m":
        minute = as_of.replace(second=0, microsecond=0)
        end = minute - timedelta(minutes=minute.minute % 5)
        return Window(end - timedelta(minutes=5), end)
    if grain == "1h":
        end = as_of.replace(minute=0, second=0, microsecond=0)
        return Window(end - timedelta(hours=1), end)
    if grain == "1d":
        return preset(as_of, "yesterday")
    raise ValueError(f"unknown grain {grain!r}")


def preset(as_of: datetime, name: str) -> Window:
    """Named date windows of the load and wash jobs."""
    today = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    day = timedelta(days=1)
    if name == "yesterday":
        return Window(today - day, today)
    if name == "wash_day":
        return Window(today - 8 * day, today - 7 * day)
    if name == "three_weeks":
        return Window(today - 22 * day, today)
    if name == "two_days":
        return Window(today - 2 * day, today)
    if name == "last_week":
        monday = today - today.weekday() * day
        return Window(monday - 7 * day, monday)
    if name == "last_month":
        return Window(_month_start(today, 1), _month_start(today))
    if name == "since_last_month":
        return Window(_month_start(today, 1), today + day)
    if name == "month_to_date":
        return Window(_month_start(today), today + day)
    raise ValueError(f"unknown window {name!r}")


GRAINS = ("5m", "1h", "1d")
PRESETS = (
    "yesterday", "wash_day", "three_weeks", "two_days", "last_week",
    "last_month", "since_last_month", "month_to_date",
)


def where_window(df: DataFrame, ts: str, window: Window) -> DataFrame:
    return df.where(window.holds(F.col(ts)))


def where_bucket(df: DataFrame, ts: str, start: datetime, minutes: int = 5) -> DataFrame:
    """Rows of one bucket as a range on the bare column."""
    return where_window(df, ts, Window(start, start + timedelta(minutes=minutes)))
