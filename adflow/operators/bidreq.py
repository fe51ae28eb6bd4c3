"""Bid request flattening, splits, counts, expectations and fraud rules."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.operators.dedup import first_by
from adflow.operators.rollup import count_by
from adflow.operators.useragent import agent_table, enrich_ua, parse_ua

KEYS = ("ad_adv", "ad_cam", "ad_grp", "InventoryIdx")
TIMES = ("tid", "actiontime_local", "actiontime_date", "actiontime_hour")
COUNT_KEYS = (*KEYS, "actiontime_date", "actiontime_hour")


def flatten_request(bronze: DataFrame) -> DataFrame:
    """Request fields one level up, next to the bid's own keys."""
    bid = [F.col(f"BidStream.{k}") for k in KEYS]
    return bronze.select(
        "BidStream.bidfloor", "BidStream.bid_price", "BidStream.request.*",
        F.col("BidStream.DeviceId").alias("device_id"), *bid, *TIMES,
    )


def split_bundle(flat: DataFrame) -> DataFrame:
    return flat.select(
        "app.bundle", "bid_price", F.col("bidfloor").alias("bid_floor"),
        "device_id", *KEYS, *TIMES,
    )


def split_banner(flat: DataFrame) -> DataFrame:
    """Size of the first impression's banner; NULL when the list is empty."""
    banner = F.get(F.col("imp"), F.lit(0))["banner"]
    return flat.select(
        banner["w"].alias("banner_w"), banner["h"].alias("banner_h"),
        "device_id", *KEYS, *TIMES,
    )


def split_geo(flat: DataFrame) -> DataFrame:
    return flat.select(
        "device.geo.country", "device.geo.region", "device.geo.lat", "device.geo.lon",
        "device.ip", *KEYS, *TIMES,
    )


def split_ua(flat: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """Parsed user agent next to what the request says about the device.

    A stream is read by the default rules.
    """
    if flat.isStreaming:
        if rules is not None:
            raise ValueError("a stream takes no rule table")
        parsed = flat.withColumn("parsed_ua", parse_ua(F.col("device.ua")))
    else:
        parsed = enrich_ua(flat, F.col("device.ua"), "parsed_ua", rules)
    return parsed.select("parsed_ua", "device.os", "device.osv", "device.make", "device.model",
                         *KEYS, *TIMES).select("parsed_ua.*", "os", "osv", "make", "model", *KEYS, *TIMES)


SPLIT_KEYS = {
    "bundle": ("bundle",),
    "banner": ("banner_w", "banner_h"),
    "geo": ("country", "region", "lat", "lon", "ip"),
    "ua": (
        "ua_device_family", "ua_os_family", "ua_os_version",
        "ua_browser_family", "ua_browser_version", "ua_is_mobile",
    ),
}
SPLITS = {
    "bundle": split_bundle, "banner": split_banner, "geo": split_geo, "ua": split_ua,
}


def count_split(flat: DataFrame, split: str) -> DataFrame:
    """Transactions per split value and key, each counted once at its first event.

    Only the key columns travel, and the group limit of ``first_by`` sends one
    row per transaction and task. User agents are counted as text; each distinct
    one is parsed once and its fields are joined to the counts.
    """
    if split == "ua":
        raw = flat.select(F.col("device.ua").alias("__ua"), *COUNT_KEYS, "tid", "actiontime_local")
        texts = count_by(_first(raw, ("__ua", *COUNT_KEYS)), ("__ua", *COUNT_KEYS))
        agents = agent_table(flat, F.col("device.ua"))
        parsed = enrich_ua(texts, F.col("__ua"), "p", agents=agents)
        keys = [F.col(f"p.{k}").alias(k) for k in SPLIT_KEYS["ua"]]
        return parsed.groupBy(*keys, *COUNT_KEYS).agg(F.sum("count").alias("count"))
    keys = (*SPLIT_KEYS[split], *COUNT_KEYS)
    rows = SPLITS[split](flat).select(*keys, "tid", "actiontime_local")
    return count_by(_first(rows, keys), keys)


def _first(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return first_by(rows, ["tid"], ["actiontime_local", *keys])


def expect_or_drop(df: DataFrame, condition: str | Column) -> DataFrame:
    """Keep rows whose condition is true; false and unknown both drop."""
    return df.where(condition)


# The fraud conditions on a flattened request.
FRAUD_RULES = {
    "fraud_os": "lower(device.os) NOT LIKE '%android%' AND lower(device.os) NOT LIKE '%ios%'",
    "fraud_ua_lang": "device.ua LIKE '%lang:%' AND device.ua NOT LIKE '%lang:ko%'",
    "fraud_emulator": "device.ua LIKE '%sdk%' AND device.ua LIKE '%x86%'",
}


def rule_flags(rules: Mapping[str, str] = FRAUD_RULES) -> list[Column]:
    return [F.coalesce(F.expr(r), F.lit(False)).alias(name) for name, r in rules.items()]


def fraud(df: DataFrame, rules: Mapping[str, str] = FRAUD_RULES, mode: str = "all") -> DataFrame:
    """Rows that match all rules, or any of them."""
    if mode not in ("all", "any"):
        raise ValueError(f"unknown mode {mode!r}")
    combine = (lambda a, b: a & b) if mode == "all" else (lambda a, b: a | b)
    return df.where(reduce(combine, [F.expr(r) for r in rules.values()]))


def with_rule_flags(df: DataFrame, rules: Mapping[str, str] = FRAUD_RULES) -> DataFrame:
    return df.select("*", *rule_flags(rules))
