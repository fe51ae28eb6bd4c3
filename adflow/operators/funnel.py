"""Bid, impression and click events joined into a funnel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.functions.timewin import between_seconds, time_bucket
from adflow.operators.dedup import first_by

KINDS = ("bid", "imp", "clk")

# Report name -> field of the event payload.
PAYLOAD = {
    "AdExchangeTypes": "AdExchangeTypes",
    "ad_adv": "ad_adv",
    "PubId": "ad_imp",
    "ad_grp": "ad_grp",
    "Width": "w",
    "Height": "h",
    "ad_crt": "ad_crt",
    "url": "bundle_domain",
    "InventoryIdx": "InventoryIdx",
    "ad_cam": "ad_cam",
    "UserId": "UserId",
    "DeviceId": "DeviceId",
}
STAT_DIMS = (
    "AdExchangeTypes", "ad_adv", "PubId", "Width", "Height",
    "url", "ad_grp", "InventoryIdx", "ad_cam",
)
ATTRIBUTES = tuple(PAYLOAD)
PRICE = "decimal(13,10)"


def silver(bronze: DataFrame, kind: str, minutes: int = 60) -> DataFrame:
    """Rename the nested payload to report names and add the time bucket ``Date``."""
    if kind not in KINDS:
        raise ValueError(f"unknown event kind {kind!r}")
    columns = ["Date", f"actiontime_local AS {kind}time"]
    columns += [f"BidStream.{field} AS {name}" for name, field in PAYLOAD.items()]
    if kind == "imp":
        columns.append(f"CAST(BidStream.win_price AS {PRICE}) AS Revenue")
    bucketed = bronze.withColumn("Date", time_bucket(F.col("actiontime_local"), minutes))
    return bucketed.selectExpr(*columns, "tid")


def first_events(events: DataFrame, kind: str, bucketed: bool = True) -> DataFrame:
    """First event of each transaction, per bucket when the job runs per bucket."""
    keys = ["Date", "tid"] if bucketed else ["tid"]
    ties = [f"{kind}time", "UserId", "url"]
    return first_by(events, keys, ties)


def bucket_counts(events: DataFrame, kind: str, dims: Sequence[str] = STAT_DIMS) -> DataFrame:
    """Events per bucket and dimension set; impressions also carry the price sum."""
    aggs = [F.count("*").alias(kind)]
    if kind == "imp":
        aggs.append(F.sum("Revenue").alias("Revenue"))
    return first_events(events, kind).groupBy("Date", *dims).agg(*aggs)


def _equal(left: str, right: str, names: Sequence[str]) -> Column:
    return F.expr(" AND ".join(f"{left}.{n} = {right}.{n}" for n in names))


def funnel_agg(
    bid: DataFrame,
    imp: DataFrame,
    clk: DataFrame,
    how: str = "left",
    dims: Sequence[str] = STAT_DIMS,
    strict_reference: bool = False,
) -> DataFrame:
    """Join the three pre-aggregated event kinds on bucket and dimensions.

    Every side is folded to one row per group before the join, so no key can be
    hot here. ``how="right"`` anchors on clicks. ``strict_reference`` repeats a
    known slip of the job this replaces: clicks count only in groups that have
    an impression.
    """
    keys = ["Date", *dims]
    b = bucket_counts(bid, "bid", dims).alias("b")
    i = bucket_counts(imp, "imp", dims).alias("i")
    c = bucket_counts(clk, "clk", dims).alias("c")
    on_click = _equal("b", "c", keys)
    if strict_reference:
        on_click = _equal("b", "c", [k for k in keys if k != "AdExchangeTypes"]) & F.expr(
            "b.AdExchangeTypes = i.AdExchangeTypes"
        )
    anchor = "c" if how == "right" else "b"
    joined = b.join(i, _equal("b", "i", keys), how).join(c, on_click, how)
    return joined.selectExpr(
        *[f"{anchor}.{k} AS {k}" for k in keys],
        *[f"coalesce({n}, 0L) AS {n}" for n in KINDS],
        f"coalesce(Revenue, CAST(0 AS {PRICE})) AS Revenue",
    )


def _attach(
    base: DataFrame, other: DataFrame, carry: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Left join one row per key, keeping only values whose attributes agree.

    Joining on the keys both sides were de-duplicated by reuses that
    partitioning: no shuffle beyond the one the de-duplication needs. Comparing
    the attributes afterwards is equal to joining on them, since the right side
    holds one row per key. NULL attributes never agree.
    """
    side = other.selectExpr(*keys, *[f"{a} AS __{a}" for a in ATTRIBUTES], *carry)
    joined = base.join(side, list(keys), "left")
    same = " AND ".join(f"{a} = __{a}" for a in ATTRIBUTES)
    return joined.selectExpr(
        *base.columns, *[f"CASE WHEN {same} THEN {c} END AS {c}" for c in carry]
    )


def _funnel(
    bid: DataFrame, imp: DataFrame, clk: DataFrame, keys: Sequence[str] = ("Date", "tid")
) -> DataFrame:
    rows = _attach(bid, imp, ["imptime", "Revenue"], keys)
    rows = _attach(rows, clk, ["clktime"], keys)
    return rows.select(
        "Date", "bidtime", "imptime", "clktime", *ATTRIBUTES, "tid", "Revenue",
        between_seconds(F.col("imptime"), F.col("clktime")).alias("ITCT"),
    )


def funnel_rows(bid: DataFrame, imp: DataFrame, clk: DataFrame) -> DataFrame:
    """Row-level funnel within one bucket (hour): bid, then impression and click."""
    return _funnel(
        first_events(bid, "bid"), first_events(imp, "imp"), first_events(clk, "clk")
    )


def _candidate_days(events: DataFrame, lookahead: int) -> DataFrame:
    """Offer each event to the days it may belong to: its own and ``lookahead`` before."""
    back = F.explode(F.sequence(F.lit(0), F.lit(lookahead)))
    return (
        events.withColumn("__back", back)
        .withColumn("Date", F.date_sub(F.to_date("Date"), F.col("__back")))
        .drop("__back")
    )


def funnel_day(
    bid: DataFrame, imp: DataFrame, clk: DataFrame, lookahead: int = 1
) -> DataFrame:
    """Row-level funnel of each day, with impressions and clicks up to a day later."""
    day = bid.withColumn("Date", F.to_date("Date"))
    return _funnel(
        first_events(day, "bid"),
        first_events(_candidate_days(imp, lookahead), "imp"),
        first_events(_candidate_days(clk, lookahead), "clk"),
    )


def funnel_gold(bid: DataFrame, imp: DataFrame, clk: DataFrame) -> DataFrame:
    """Funnel over globally de-duplicated events, without any time bound."""
    return _funnel(
        first_events(bid, "bid", bucketed=False),
        first_events(imp, "imp", bucketed=False),
        first_events(clk, "clk", bucketed=False),
        keys=["tid"],
    )
