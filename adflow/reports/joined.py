"""Reports that combine several landed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adflow.functions.names import (
    conform,
    fill_metrics,
    flatten,
    normalize,
    normalize_names,
    null_types_to_string,
    propagate,
    rename_map,
    snake_to_camel,
)
from adflow.functions.scalars import id_from_number_text
from adflow.operators.dedup import dedup_on
from adflow.operators.sets import enrich, left_lookup, left_metric
from adflow.operators.web import explode_daily
from adflow.reports import channels as ch
from adflow.sources.readers import drop_all_null


def with_orientation(assets: DataFrame, orientations: DataFrame) -> DataFrame:
    """Asset report and the orientation of its videos (``youtubeVideoID, orientation``)."""
    return left_lookup(assets, orientations, "assetYoutubeVideoID", "youtubeVideoID")


def installs_by_adgroup(adgroups: DataFrame, installs: DataFrame) -> DataFrame:
    """Ad group report with the positive sums of app installs."""
    return left_metric(adgroups, installs, ch.INSTALL_KEYS, "metricsInstallConversions")


def kakao_creatives(
    report: DataFrame, creatives: DataFrame, adgroups: DataFrame, target: T.StructType | None = None
) -> DataFrame:
    """Creative metrics with creative, ad group and campaign names.

    ``report`` is nested (``dimensions``, ``metrics``); ad group attributes are
    carried onto the creatives first.
    """
    named = propagate(
        creatives, adgroups, "adgroupId",
        {"name": "adgroupName", "campaignId": "campaignId", "campaignName": "campaignName"},
    )
    rows = normalize_names(flatten(report, sep=".")).withColumnRenamed("creativeId", "id")
    out = rows.join(named, "id")
    return conform(out, target) if target else out


def kakao_keywords(
    report: DataFrame, channels: DataFrame, keywords: DataFrame, drop: Sequence[str] = ()
) -> DataFrame:
    """Keyword metrics with the business channel of the ad group and the keyword text."""
    rows = normalize_names(flatten(report, sep="."))
    biz = channels.withColumnsRenamed({"id": "bizChannelId", "name": "bizChannelName"})
    joined = enrich(rows, [(biz, ["adGroupId"])]).drop(*drop).dropDuplicates()
    names = keywords.select(F.col("id").alias("keywordId"), "text")
    return normalize_names(enrich(joined, [(names, ["keywordId"])]))


def tweet_stats(stats: DataFrame, metrics: Mapping[str, str], start: str) -> DataFrame:
    """Daily rows out of the parallel metric arrays of each promoted tweet."""
    flat = normalize(stats, "id_data", ["id"]).withColumnRenamed("id", "statId")
    arrays = {name: f"metrics_{path}" for name, path in metrics.items()}
    return explode_daily(flat, ["statId"], arrays, start)


def promoted_tweets(
    promoted: DataFrame, tweets: DataFrame, stats: DataFrame, line_items: DataFrame,
    campaigns: DataFrame,
) -> DataFrame:
    """Promoted tweet statistics with tweet, line item and campaign names.

    Rows with equal metrics collapse into one, the smallest ids staying.
    """
    rows = enrich(promoted, [(tweets, ["tweetId"]), (stats, ["statId"])]).distinct()
    rows = null_types_to_string(rows)
    rows = enrich(rows, [(line_items, ["lineItemId"]), (campaigns, ["campaignId"])])
    return dedup_on(rows, "metrics", ["statId", "segmentDate", "tweetId", "lineItemId", "campaignId"])


def organic_tweets(sheet: DataFrame, mapping: DataFrame) -> DataFrame:
    """Organic tweet sheet joined with the sheet that names the creatives."""
    rows = rename_map(drop_all_null(sheet), ch.ORGANIC_HEADERS)
    names = rename_map(drop_all_null(mapping), ch.ORGANIC_MAPPING_HEADERS, only=True)
    tweet = id_from_number_text(F.col("tweetId"))
    names = names.withColumn("tweetId", tweet).drop("campaignName")
    return rows.withColumn("tweetId", tweet).join(names, "tweetId")


def airbridge_stats(landed: DataFrame) -> DataFrame:
    """Channel totals of the app attribution report, gaps as 0."""
    rows = landed.select("event_date", "channel", *ch.AIRBRIDGE_METRICS)
    return fill_metrics(snake_to_camel(rows))


def export_fields(df: DataFrame, fields: DataFrame, entity: str) -> DataFrame:
    """Columns of a raw export that a field table marks for an entity (``y``).

    The field table is configuration: one row per column of the export.
    """
    marked = fields.where(F.col(entity) == "y").select("dimension").collect()
    wanted = {r["dimension"] for r in marked}
    return df.select(*[c for c in df.columns if c in wanted])
