"""Nested analytics rows: key/value pivots, metric arrays, JSON text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.functions.names import camel
from adflow.functions.timewin import KST

# Event parameters of the web analytics flatten, and the value
# field that carries each.
GA4_PARAMS = {
    "prod": "string_value",
    "ga_session_id": "int_value",
    "ga_session_number": "int_value",
    "page_location": "string_value",
    "page_title": "string_value",
    "page_referrer": "string_value",
    "campaign": "string_value",
    "medium": "string_value",
    "source": "string_value",
    "term": "string_value",
    "content": "string_value",
    "engagement_time_msec": "int_value",
    "percent_scrolled": "int_value",
}
GA4_KEYS = {
    "event_date": "event_date",
    "event_name": "event_name",
    "event_timestamp": "event_timestamp",
    "user_pseudo_id": "user_pseudo_id",
    "user_id": "user_id",
    "stream_id": "stream_id",
    "platform": "platform",
    "user_first_touch_timestamp": "user_first_touch_timestamp",
    "category": "device.category",
    "region": "geo.region",
    "city": "geo.city",
    "t_name": "traffic_source.name",
    "t_medium": "traffic_source.medium",
    "t_source": "traffic_source.source",
}


def ga4_flatten(
    df: DataFrame,
    params: Mapping[str, str] = GA4_PARAMS,
    exclude: Sequence[str] = (),
    zone: str = KST,
) -> DataFrame:
    """One row per event with its parameters as columns.

    Parameters are read out of the array in place and events without any are
    left out. Equal event tuples then merge, each parameter at its largest value.
    Because that happens per row first, the shuffle carries one row per event,
    not one per parameter. A key is found by position, which compiles; only
    events that repeat a key look at each of its values.
    """
    if exclude:
        df = df.where(~F.col("event_name").isin(*exclude))
    rows = df.where(F.size("event_params") > 0)
    # Times without a zone throughout, so the session's zone plays no part.
    seconds = "CAST(event_timestamp / 1000000BD AS DECIMAL(18, 6))"
    local = F.expr(
        f"convert_timezone('UTC', '{zone}', "
        f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds}))"
    )

    def largest(key: str, field: str) -> str:
        values = f"event_params.value.{field}"
        found = f"size(__keys) - size(array_remove(__keys, '{key}'))"
        every = f"array_max(transform(event_params, p -> IF(p.key = '{key}', p.value.{field}, NULL)))"
        return (
            f"CASE {found} WHEN 0 THEN NULL"
            f" WHEN 1 THEN get({values}, CAST(array_position(__keys, '{key}') AS INT) - 1)"
            f" ELSE {every} END AS p_{key}"
        )

    flat = rows.withColumns(
        {"__keys": F.col("event_params.key"), "event_time": local}
    ).selectExpr(
        *[f"{path} AS {name}" for name, path in GA4_KEYS.items()], "event_time",
        *[largest(key, field) for key, field in params.items()],
    )
    return flat.groupBy(*GA4_KEYS, "event_time").agg(
        *[F.max(f"p_{key}").alias(key) for key in params]
    )


def unnest(df: DataFrame, array: str, keep: Sequence[str]) -> DataFrame:
    """One row per element of a struct array; rows with an empty array drop out."""
    return df.select(*keep, F.explode(array).alias("__e")).select(*keep, "__e.*")


def pivot_actions(
    actions: str, types: Sequence[str], prefix: str = ""
) -> dict[str, Column]:
    """Columns for the listed action types of an array; the last match wins.

    Types that do not occur give NULL. ``prefix`` marks a second array
    (``unique_actions``) in the names.
    """

    def last(kind: str) -> Column:
        # The first match from the end.
        place = f"array_position(reverse({actions}.action_type), '{kind}')"
        return F.expr(f"get(reverse({actions}.value), CAST({place} AS INT) - 1)")

    return {camel(f"{prefix}{kind}"): last(kind) for kind in types}


def first_value(array: str, field: str = "value") -> Column:
    return F.get(F.col(array), F.lit(0))[field]


def default_metrics(df: DataFrame, cols: Sequence[str], kind: str = "string") -> DataFrame:
    """Missing, empty or zero metrics become "0"; columns not there are added.

    Stays text by default, the way the channel reports it; ``kind`` casts.
    """

    def filled(name: str) -> Column:
        if name not in df.columns:
            return F.lit("0").cast(kind)
        text = F.col(name).cast("string")
        return F.when(text.isNull() | (text == ""), "0").otherwise(text).cast(kind)

    return df.withColumns({name: filled(name) for name in cols})


def explode_daily(
    df: DataFrame, keys: Sequence[str], arrays: Mapping[str, str], start: str,
    date_name: str = "segmentDate",
) -> DataFrame:
    """Parallel daily arrays to one row per day.

    The date follows from the position, so a day without any number is dropped
    without moving the days after it. Remaining gaps become 0.
    """
    metrics = list(arrays)
    padded = [
        F.coalesce(F.col(path), F.array().cast("array<double>")).cast("array<double>").alias(name)
        for name, path in arrays.items()
    ]
    days = df.select(*keys, *padded).select(
        *keys, F.posexplode(F.arrays_zip(*metrics)).alias("__day", "__m")
    )
    day = F.date_add(F.lit(start).cast("date"), F.col("__day"))
    return (
        days.select(*keys, day.alias(date_name), *[F.col(f"__m.{m}").alias(m) for m in metrics])
        .dropna("all", subset=metrics)
        .fillna(0.0, subset=metrics)
    )


def expand_json(
    df: DataFrame, column: str, path: str, ddl: str, out: str, outer: bool = False
) -> DataFrame:
    """JSON array inside a text column to rows."""
    parsed = F.from_json(F.get_json_object(column, path), ddl)
    explode = F.explode_outer if outer else F.explode
    return df.withColumn(out, explode(parsed))
