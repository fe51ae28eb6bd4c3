"""Small column functions of the report and training jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def null_if_blank(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def micros_to_currency(micros: Column) -> Column:
    """Whole currency units; a half goes to the even neighbour (2.5 -> 2, 3.5 -> 4)."""
    return F.bround(micros.cast("double") * 0.000001).cast("long")


def after_marker(urls: Column, marker: str = "mkt_") -> Column:
    """Text between the first and second ``marker`` of the first URL; NULL when absent."""
    return F.get(F.split(F.get(urls, F.lit(0)), marker, -1), F.lit(1))


def video_url(kind: Column, video_id: Column) -> Column:
    """Watch address of video assets (type code 2), empty for the other types."""
    return F.when(kind == 2, F.concat(F.lit("https://www.youtube.com/watch?v="), video_id)).otherwise("")


def orientation(width: Column, height: Column) -> Column:
    return (
        F.when(width == height, "Square")
        .when(width > height, "Landscape")
        .otherwise("Portrait")
    )


def id_from_number_text(text: Column, strict: bool = True) -> Column:
    """Id printed as a number (``1.4E17``) to a long, without passing a double.

    A number that no long holds stops the job; with ``strict=False`` its id is NULL.
    """
    number = text.cast("decimal(38,0)")
    return number.cast("long") if strict else number.try_cast("long")


def decode_base64(text: Column) -> Column:
    return F.unbase64(text).cast("string")


def flag_from_int(value: Column) -> Column:
    """'1' for a positive count, else the count as text."""
    return F.when(value > 0, "1").otherwise(value.cast("string"))


def bid_flag(bid: Column) -> Column:
    return F.when(bid.isNotNull(), "1")


def imp_flag(bid: Column, imp: Column) -> Column:
    return F.when(bid.isNotNull() & imp.isNotNull(), "1").otherwise("0")


def clk_flag(bid: Column, imp: Column, clk: Column) -> Column:
    return F.when(bid.isNotNull() & imp.isNotNull() & clk.isNotNull(), "1").otherwise("0")


def conversion(*events: Column) -> Column:
    """1.0 when any request event happened, else 0.0."""
    hit = F.lit(False)
    for event in events:
        hit = hit | F.coalesce(event > 0, F.lit(False))
    return F.when(hit, 1.0).otherwise(0.0)


def stable_id(*parts: Column) -> Column:
    """Repeatable substitute for a random id."""
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)
