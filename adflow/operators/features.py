"""Bid-level features and the conversion training set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.functions.recode import app_category, device_type, os_class, recode_region, size_class
from adflow.functions.scalars import (
    bid_flag,
    clk_flag,
    conversion,
    flag_from_int,
    imp_flag,
    null_if_blank,
)
from adflow.operators.skew import assert_unique, fanout_left_join, skew_join, staged


def request_attributes(bronze: DataFrame) -> DataFrame:
    """Device, placement and place of each bid request."""
    device = "BidStream.request.device"
    rows = bronze.select(
        "tid",
        F.lower(f"{device}.os").alias("os"),
        F.lower(f"{device}.make").alias("deviceMake"),
        F.col(f"{device}.devicetype").alias("deviceType"),
        F.lower(f"{device}.model").alias("deviceModel"),
        F.get("BidStream.request.imp", F.lit(0))["tagid"].alias("tagid"),
        F.col("BidStream.bundle_domain").alias("bundle"),
        F.col("BidStream.bidfloor").cast("double").alias("bidfloor"),
        F.col(f"{device}.geo.country").alias("country"),
        F.col(f"{device}.geo.region").alias("region"),
        F.col(f"{device}.geo.lat").cast("string").alias("lat"),
        F.col(f"{device}.geo.lon").cast("string").alias("lon"),
        "actiontime_date",
    )
    return recode_region(rows, "region", "region")


def with_category(bids: DataFrame, apps: DataFrame) -> DataFrame:
    """App store category by bundle. ``apps`` has ``bundle`` and ``category``.

    A few bundles bring most of the traffic, so their bids are spread.
    """
    return app_category(skew_join(bids, apps, ["bundle"], "left"), "category", "appCategory")


def with_request(stats: DataFrame, requests: DataFrame, start: str, end: str) -> DataFrame:
    """Funnel rows with the request attributes of their transaction.

    The date bound belongs to the match: rows outside it stay, without
    attributes. Every bid of a transaction matches, repeats included.
    """
    inside = F.to_date("Date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    keyed = stats.withColumn("__tid", F.when(inside, F.col("tid")))
    side = requests.withColumnRenamed("tid", "__tid")
    return fanout_left_join(keyed, side, ["__tid"]).drop("__tid")


FEATURES = (
    "Date", "DeviceId", "tid", "bid", "imp", "clk", "size", "bidfloor", "appCategory",
    "deviceType", "os", "region",
)


def bid_features(
    funnel: DataFrame, bids: DataFrame, apps: DataFrame, start: str, end: str
) -> DataFrame:
    """Categorical view of each bid: flags, size, device, place and app class.

    The joined rows are staged before the look-up by bundle, which reads them twice.
    """
    in_days = F.col("actiontime_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    requests = request_attributes(bids.where(in_days)).drop("actiontime_date")
    rows = staged(with_request(funnel, requests, start, end), "bid-requests")
    rows = with_category(rows, apps)
    b, i, c = F.col("bidtime"), F.col("imptime"), F.col("clktime")
    return rows.select(
        "Date", "DeviceId", "tid",
        bid_flag(b).alias("bid"), imp_flag(b, i).alias("imp"), clk_flag(b, i, c).alias("clk"),
        size_class(F.col("Width"), F.col("Height")).alias("size"),
        "bidfloor",
        null_if_blank(F.col("appCategory")).alias("appCategory"),
        "deviceType",
        os_class(F.col("os")).alias("os"),
        F.regexp_replace("region", "KR-", "").alias("region"),
    )


def labelled_days(web: DataFrame, requests: Sequence[str]) -> DataFrame:
    """Web conversion days with the label ``cv``: 1.0 when any request event happened."""
    flags = [F.col(r) for r in requests]
    return web.where(F.col("Date").isNotNull()).withColumn(
        "newUser", flag_from_int(F.col("newUser"))
    ).withColumn("cv", conversion(*flags))


def training_set(
    features: DataFrame, dmp: DataFrame, web: DataFrame, unique: bool = False
) -> DataFrame:
    """Bid features, audience data by device, and labelled web days by transaction.

    Opted-out users share one device id, so the audience join is salted. Bids
    without a web day have no label; they become class 2.0. The web side may
    hold several days per transaction, which multiplies the bid;
    ``unique=True`` refuses that.
    """
    people = dmp.where("id_type = 'ADID'").select(
        F.col("uuid").alias("DeviceId"), F.col("gender_code").cast("string").alias("gender"),
        F.col("age_range").alias("age"), "carrier",
    )
    if unique:
        assert_unique(people, ["DeviceId"])
        assert_unique(web, ["tid", "DeviceId"])
    rows = skew_join(staged(features, "features"), people, ["DeviceId"], "left")
    days = web.drop("Date")
    rows = fanout_left_join(rows, days, ["tid", "DeviceId"])
    return rows.withColumn("dow", F.dayofweek("Date").cast("string")).fillna(2.0, subset=["cv"])


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]


def low_cardinality(df: DataFrame, limit: int = 100, approx: bool = False) -> DataFrame:
    """String columns with their distinct counts, and whether they stay in the model."""
    from adflow.operators.rollup import cardinality

    names = string_columns(df)
    counts = cardinality(df, names, approx)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct")) for c in names
    ]))
    return counts.select(rows.alias("r")).select("r.*", (F.col("r.distinct") <= limit).alias("keep"))


def kept_columns(df: DataFrame, limit: int = 100) -> list[str]:
    """Names out of ``low_cardinality``: one short row per string column."""
    return [r["column"] for r in low_cardinality(df, limit).where("keep").collect()]


def fill_missing(df: DataFrame, cols: Sequence[str], value: str = "missing") -> DataFrame:
    return df.fillna({c: value for c in cols})


def impute_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean in place of NULL, in ``{name}_imputed``. Columns without a value stay NULL.

    All means come from one scalar subquery.
    """
    numbers = {c: F.col(c).cast("double") for c in cols}
    means = df.select(F.struct(*[F.avg(n).alias(c) for c, n in numbers.items()])).scalar()
    return df.withColumns({
        f"{c}_imputed": F.coalesce(n, means[c]) for c, n in numbers.items()
    })


def split(df: DataFrame, key: Sequence[str], weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Parts in given proportions, decided by a hash of the key.

    A random split depends on how rows are laid out; this one does not, and the
    copies of a key stay together.
    """
    total = sum(weights)
    part = F.col("__part")
    tagged = df.withColumn("__part", split_point(key, seed))
    out, low = [], 0.0
    for weight in weights:
        high = low + weight / total * SPLIT_RANGE
        out.append(tagged.where((part >= round(low)) & (part < round(high))).drop("__part"))
        low = high
    return out


SPLIT_RANGE = 10_000


def split_point(key: Sequence[str], seed: int) -> Column:
    """Even number in [0, 10000) out of the key."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % SPLIT_RANGE
