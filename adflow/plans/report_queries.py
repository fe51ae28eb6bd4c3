"""Channel reports from landed rows built out of line items and orders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from adflow.functions.timewin import Window, preset
from adflow.operators.skew import staged
from adflow.plans.registry import ORACLES, query
from adflow.plans.report_sql import REPORTS
from adflow.plans.views import exprs, read, struct_text
from adflow.reports import channels as ch
from adflow.reports import joined as jn
from adflow.reports.engine import (
    load_report,
    normalize_report,
    table_name,
    union_facts,
)
from adflow.session import temp_database
from adflow.sources import readers as rd
from adflow.sources import sinks as sk

AS_OF = datetime(1999, 6, 20)
JOINED = "lineitem JOIN orders ON l_orderkey = o_orderkey"
URL = "concat('https://shop.example/', CAST(l_partkey AS STRING), CASE WHEN l_returnflag = 'R' THEN '' ELSE concat('?mkt_', l_linestatus, CAST(l_suppkey AS STRING)) END)"
WORD = "concat('word ', CAST(l_partkey % 30 AS STRING))"

GENERIC_METRICS = """interactions view_through_conversions conversions_from_interactions_rate cost_per_conversion
all_conversions all_conversions_from_interactions_rate cost_per_all_conversions video_quartile_p100_rate video_quartile_p25_rate
video_quartile_p50_rate video_quartile_p75_rate video_views video_view_rate all_conversions_value conversions_value
cross_device_conversions value_per_conversion average_cpv average_cpm average_cpe average_cpc average_cost interaction_rate
active_view_ctr active_view_cpm active_view_impressions active_view_viewability search_impression_share
biddable_app_install_conversions biddable_app_post_install_conversions""".split()

# Landed path -> expression both engines read.
LEAVES = {
    "segments.date": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
    "segments.device": "CAST(l_linenumber AS INT)",
    "segments.ad_network_type": "CAST(l_partkey % 8 AS INT)",
    "segments.keyword.info.text": WORD,
    "segments.conversion_action_name": "CASE l_returnflag WHEN 'R' THEN 'purchase' WHEN 'A' THEN 'signup' ELSE 'call' END",
    "campaign.id": "CAST(o_custkey % 50 AS BIGINT)",
    "campaign.name": "concat('campaign ', CAST(o_custkey % 50 AS STRING))",
    "campaign.advertising_channel_type": "CAST(o_custkey % 3 AS INT)",
    "campaign.advertising_channel_sub_type": "CAST(o_custkey % 2 AS INT)",
    "campaign.optimization_score": "CAST(o_custkey % 100 AS DOUBLE) / 4",
    "ad_group.id": "CAST(l_partkey % 40 AS BIGINT)",
    "ad_group.name": "concat('group ', CAST(l_partkey % 40 AS STRING))",
    "ad_group.status": "l_linestatus",
    "ad_group.type_": "CAST(l_partkey % 5 AS INT)",
    "ad_group_ad.ad.id": "l_suppkey",
    "ad_group_ad.ad.name": "concat('ad ', CAST(l_suppkey AS STRING))",
    "ad_group_ad.ad.resource_name": "concat('customers/1/ads/', CAST(l_suppkey AS STRING))",
    "ad_group_ad.ad.final_urls": URL,
    "ad_group_ad.ad.responsive_display_ad.long_headline.text": "concat('headline ', CAST(l_suppkey % 9 AS STRING))",
    "ad_group_ad.ad.responsive_display_ad.descriptions": "concat('text ', CAST(l_suppkey % 6 AS STRING))",
    "ad_group_criterion.criterion_id": "CAST(l_partkey % 300 AS BIGINT)",
    "ad_group_criterion.keyword.text": WORD,
    "ad_group_criterion.keyword.match_type": "CAST(l_partkey % 4 AS INT)",
    "search_term_view.search_term": "concat('term ', CAST(l_partkey % 60 AS STRING))",
    "asset.id": "CAST(l_partkey AS BIGINT)",
    "asset.name": "concat('asset ', CAST(l_partkey AS STRING))",
    "asset.type_": "CAST(l_partkey % 7 AS INT)",
    "asset.text_asset.text": "concat('copy ', CAST(l_partkey % 11 AS STRING))",
    "asset.image_asset.full_size.url": "concat('https://img.example/', CAST(l_partkey AS STRING))",
    "asset.youtube_video_asset.youtube_video_id": "concat('v', CAST(l_partkey % 25 AS STRING))",
    "asset.youtube_video_asset.youtube_video_title": "concat('title ', CAST(l_partkey % 25 AS STRING))",
    "ad_group_ad_asset_view.field_type": "CAST(l_suppkey % 9 AS INT)",
    "ad_group_ad_asset_view.performance_label": "CAST(l_suppkey % 8 AS INT)",
    "ad_group_ad_asset_view.enabled": "l_returnflag <> 'N'",
    "metrics.impressions": "CAST(l_quantity * 10 AS BIGINT)",
    "metrics.clicks": "CAST(l_quantity AS BIGINT)",
    "metrics.cost_micros": "CASE WHEN l_linenumber = 1 THEN 0 ELSE CAST(round(l_extendedprice * 100) AS BIGINT) * 10000 END",
    "metrics.conversions": "CAST(round(l_discount * 100) AS BIGINT)",
    "metrics.ctr": "l_discount",
    **{f"metrics.{m}": f"CAST((l_orderkey + l_partkey + {i}) % 97 AS BIGINT)" for i, m in enumerate(GENERIC_METRICS)},
}
ARRAYS = {
    "ad_group_ad.ad.final_urls": "array({}, 'https://other.example/?mkt_second')",
    "ad_group_ad.ad.responsive_display_ad.descriptions": "array(named_struct('text', {}))",
}


def _nested(paths, prefix=""):
    """Nest dotted paths into struct texts by their first step."""
    out = {}
    for head in dict.fromkeys(p.split(".")[0] for p in paths):
        full = f"{prefix}{head}"
        if full in LEAVES:
            out[head] = ARRAYS.get(full, "{}").format(LEAVES[full])
        else:
            rest = [p.split(".", 1)[1] for p in paths if p.startswith(f"{head}.")]
            out[head] = struct_text(_nested(rest, f"{full}."))
    return out


def _lines(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = read(spark, sf_dir, "lineitem")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def google_landed(spark, sf_dir, lines=None):
    lines = _lines(spark, sf_dir) if lines is None else lines
    return lines.selectExpr(*exprs(_nested(list(LEAVES))))


def filled(name, leaves):
    """The written-out SELECT and WHERE of a report over the fixture's landed values."""
    select, _, where = REPORTS[name].strip().partition("\nWHERE ")
    for path, text in leaves.items():
        select, where = (part.replace(f"{{{path}}}", text) for part in (select, where))
    return select, where or "true"


def google_sql(name, window=None, constants=""):
    select, where = filled(name, LEAVES)
    if window:
        where += f" AND {LEAVES['segments.date']} >= '{window.first_day}' AND {LEAVES['segments.date']} <= '{window.last_day}'"
    return f"{select}{constants} FROM {JOINED} WHERE {where}"


def _google(name, spec, window=None, **constants):
    extra = "".join(f", '{v}' AS \"{k}\"" for k, v in constants.items())

    @query(name, google_sql(spec.name, window, extra))
    def run(spark, sf_dir):
        return normalize_report(google_landed(spark, sf_dir), spec, window, **constants)


_google("c1_google_ad", ch.GOOGLE_AD, customerName="main")
_google("c2_google_keyword", ch.GOOGLE_KEYWORD, preset(AS_OF, ch.GOOGLE_KEYWORD.window))
_google("c3_google_search_term", ch.GOOGLE_SEARCH_TERM)
_google("c4_google_conversion_type", ch.GOOGLE_CONVERSION_TYPE)
_google("c5_google_adgroup", ch.GOOGLE_ADGROUP, customerName="AC")
_google("c8_google_ad_asset", ch.GOOGLE_AD_ASSET)
_google("c9_google_marked_ad", ch.GOOGLE_MARKED_AD, preset(AS_OF, "yesterday"))
_google("c9_google_marked_ad_wash", ch.GOOGLE_MARKED_AD, preset(AS_OF, "wash_day"), washDate="1999-06-20")
_google("c20_google_keyword_view", ch.GOOGLE_KEYWORD_VIEW)
_google("c21_google_campaign", ch.GOOGLE_CAMPAIGN)
_google("c22_google_ad_viewability", ch.GOOGLE_AD_VIEWABILITY)
_google("c23_google_responsive", ch.GOOGLE_RESPONSIVE, preset(AS_OF, ch.GOOGLE_RESPONSIVE.window))
_google("c25_google_asset_history", ch.GOOGLE_ASSET_HISTORY)
_google("c25_google_asset_history_installs", ch.GOOGLE_ASSET_HISTORY_INSTALLS)

SHARE = ch.GOOGLE_IMPRESSION_SHARE
WASH_DAY = preset(AS_OF, "wash_day")


@query(
    "c24_google_impression_share_wash",
    f"""{google_sql("google_impression_share", WASH_DAY, ", '1999-06-20' AS \"washDate\"")}
UNION ALL {google_sql("google_impression_share", preset(AS_OF, "yesterday"), ", '1999-06-19' AS \"washDate\"")}""",
)
def impression_share_wash(spark, sf_dir):
    """The wash day is loaded twice into a table that holds yesterday, too: yesterday stays, and
    the second run leaves no second copy of the wash day."""
    table = f"{temp_database(spark, 'share')}.{table_name('google', 'main', 'keyword', wash=True)}"
    landed = google_landed(spark, sf_dir)
    sk.overwrite(normalize_report(landed, SHARE, preset(AS_OF, "yesterday"), washDate="1999-06-19"), table, ["washDate"])
    rows = normalize_report(landed, SHARE, WASH_DAY, washDate="1999-06-20")
    for _ in range(2):
        load_report(rows, table, SHARE, WASH_DAY)
    return spark.table(table)


ORIENTATION_SQL = "SELECT concat('v', CAST(n_nationkey AS STRING)) AS \"youtubeVideoID\", CASE n_regionkey WHEN 0 THEN 'Square' WHEN 1 THEN 'Landscape' ELSE 'Portrait' END AS orientation FROM nation"


@query("c6_google_asset_orientation", f"SELECT * FROM ({google_sql('google_asset')}) LEFT JOIN ({ORIENTATION_SQL}) ON \"assetYoutubeVideoID\" = \"youtubeVideoID\"")
def asset_orientation(spark, sf_dir):
    videos = read(spark, sf_dir, "nation").selectExpr(
        "concat('v', CAST(n_nationkey AS STRING)) AS youtubeVideoID",
        "CASE n_regionkey WHEN 0 THEN 'Square' WHEN 1 THEN 'Landscape' ELSE 'Portrait' END AS orientation",
    )
    return jn.with_orientation(normalize_report(google_landed(spark, sf_dir), ch.GOOGLE_ASSET), videos)


KEYS7 = ", ".join(f'"{k}"' for k in ch.INSTALL_KEYS)


@query(
    "c7_google_installs",
    f"""WITH a AS ({google_sql('google_install_adgroup')}), i AS (SELECT {KEYS7}, CAST(SUM("metricsInstallConversions") AS BIGINT) AS "metricsInstallConversions"
  FROM ({google_sql('google_installs')}) GROUP BY ALL HAVING SUM("metricsInstallConversions") > 0)
SELECT a.*, i."metricsInstallConversions" FROM a LEFT JOIN i USING ({KEYS7})""",
)
def google_installs(spark, sf_dir):
    landed = google_landed(spark, sf_dir)
    return jn.installs_by_adgroup(
        normalize_report(landed, ch.GOOGLE_INSTALL_ADGROUP), normalize_report(landed, ch.GOOGLE_INSTALLS)
    )


# --- social channels -------------------------------------------------------

QTY = "CAST(CAST(l_quantity AS BIGINT) AS STRING)"
FB = {
    "account_id": "CAST(o_custkey % 4 AS STRING)",
    "ad_id": "CAST(l_suppkey AS STRING)",
    "ad_name": "concat('ad ', CAST(l_suppkey AS STRING))",
    "adset_id": "CAST(l_partkey % 40 AS STRING)",
    "adset_name": "concat('set ', CAST(l_partkey % 40 AS STRING))",
    "campaign_id": "CAST(o_custkey % 50 AS STRING)",
    "campaign_name": "concat('campaign ', CAST(o_custkey % 50 AS STRING))",
    "date_start": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
    "date_stop": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
    "impressions": "CAST(CAST(l_quantity * 10 AS BIGINT) AS STRING)",
    "frequency": "CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_linenumber AS STRING) END",
    "reach": "CASE WHEN l_linenumber = 2 THEN '' ELSE CAST(l_linenumber AS STRING) END",
    "spend": "CAST(CAST(round(l_extendedprice) AS BIGINT) AS STRING)",
}
VIDEO = ("video_p25_watched_actions", "video_p50_watched_actions", "video_p75_watched_actions", "video_p100_watched_actions", "video_play_actions")
FB_VIDEO = "CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_suppkey + {i} AS STRING) END"
FB_LEAF = {**FB, **{v: FB_VIDEO.format(i=i) for i, v in enumerate(VIDEO)}}
FB_LINK = f"CASE l_returnflag WHEN 'R' THEN CAST(CAST(l_quantity AS BIGINT) + 1 AS STRING) WHEN 'A' THEN NULL ELSE {QTY} END"


def facebook_landed(spark, sf_dir, lines=None):
    lines = _lines(spark, sf_dir) if lines is None else lines

    def action(kind, value):
        return F.struct(F.lit(kind).alias("action_type"), F.expr(value).alias("value"))

    again = "CAST(CAST(l_quantity AS BIGINT) + 1 AS STRING)"
    base = F.array(action("link_click", QTY), action("app_install", "CAST(l_linenumber AS STRING)"))
    twice = F.concat(base, F.array(action("link_click", again)))
    actions = F.when(F.col("l_returnflag") == "R", twice).when(F.col("l_returnflag") == "N", base)
    video = [
        F.when(F.col("l_returnflag") != "N", F.array(F.struct(F.expr(f"CAST(l_suppkey + {i} AS STRING)").alias("value")))).alias(v)
        for i, v in enumerate(VIDEO)
    ]
    return lines.select(
        *[F.expr(e).alias(n) for n, e in FB.items()], *video, actions.alias("actions"), actions.alias("unique_actions"),
    )


FB_LEAF |= {"link_click": FB_LINK, "app_install": "CASE l_returnflag WHEN 'A' THEN NULL ELSE CAST(l_linenumber AS STRING) END"}


def facebook_sql(name):
    return f"{filled(name, FB_LEAF)[0]} FROM {JOINED}"


FB_SQL = facebook_sql("facebook_ad")


@query("c10_facebook_ad", FB_SQL)
def facebook_ad(spark, sf_dir):
    return normalize_report(facebook_landed(spark, sf_dir), ch.FACEBOOK_AD)


@query("c10_facebook_account", facebook_sql("facebook_account"))
def facebook_account(spark, sf_dir):
    return normalize_report(facebook_landed(spark, sf_dir), ch.FACEBOOK_ACCOUNT)


FB_KEYS = ", ".join(f'"{k}"' for k in ch.FACEBOOK_KEYS)
FB_DESC = ", ".join(f'"{k}"' for k in ch.FACEBOOK_DESCRIPTORS)
FB_METRICS = ch.FACEBOOK_WASH_METRICS
FB_MATCH = " AND ".join(f'r."{k}" = w."{k}"' for k in ch.FACEBOOK_KEYS)


@query(
    "c11_facebook_overlay",
    f"""WITH raw AS ({FB_SQL}), wash AS (SELECT {FB_KEYS}, {", ".join(f'max("{m}") AS "{m}"' for m in FB_METRICS)} FROM raw WHERE "reach" = '0' GROUP BY ALL)
SELECT {", ".join(f'r."{c}"' for c in (*ch.FACEBOOK_KEYS, *ch.FACEBOOK_DESCRIPTORS))}, {", ".join(f'w."{m}"' for m in FB_METRICS)}, '1999-06-20' AS "washDate"
FROM (SELECT DISTINCT {FB_KEYS}, {FB_DESC} FROM raw) r JOIN wash w ON {FB_MATCH}
UNION ALL SELECT {", ".join(f'r."{c}"' for c in (*ch.FACEBOOK_KEYS, *ch.FACEBOOK_DESCRIPTORS, *FB_METRICS))}, '1999-06-20' FROM raw r WHERE NOT EXISTS (SELECT 1 FROM wash w WHERE {FB_MATCH})""",
)
def facebook_overlay(spark, sf_dir):
    from adflow.functions.names import stamp
    from adflow.operators.sets import overlay

    raw = normalize_report(facebook_landed(spark, sf_dir), ch.FACEBOOK_AD)
    wash = raw.where("reach = '0'").groupBy(*ch.FACEBOOK_KEYS).agg(*[F.max(m).alias(m) for m in FB_METRICS])
    return stamp(overlay(raw, wash, ch.FACEBOOK_KEYS, ch.FACEBOOK_DESCRIPTORS, FB_METRICS), washDate="1999-06-20")


@query(
    "c12_kakao_creatives",
    """SELECT l_suppkey AS id, CAST(CAST(l_shipdate AS DATE) AS STRING) AS start, l_quantity AS "metricsClick", l_extendedprice AS "metricsCostSum",
  s_name AS name, CAST(s_nationkey AS BIGINT) AS "adgroupId", n_name AS "adgroupName", CAST(n_regionkey AS BIGINT) AS "campaignId", r_name AS "campaignName"
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def kakao_creatives(spark, sf_dir):
    landed = read(spark, sf_dir, "lineitem").select(
        F.struct(F.col("l_suppkey").alias("creative_id")).alias("dimensions"),
        F.struct(F.col("l_quantity").alias("click"), F.col("l_extendedprice").alias("cost_sum"), F.col("l_tax").alias("unused")).alias("metrics"),
        F.to_date("l_shipdate").cast("string").alias("start"),
    )
    creatives = read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "CAST(s_nationkey AS BIGINT) AS adgroupId")
    region = read(spark, sf_dir, "region")
    adgroups = read(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "CAST(n_nationkey AS BIGINT) AS adgroupId", "n_name AS name", "CAST(n_regionkey AS BIGINT) AS campaignId", "r_name AS campaignName"
    )
    out = jn.kakao_creatives(landed, creatives, adgroups)
    return out.drop("metricsUnused")


@query(
    "c13_kakao_keywords",
    """SELECT DISTINCT l_linenumber AS "adGroupId", l_partkey AS "keywordId", l_quantity AS "metricsImpression", r_name AS "bizChannelName",
  CAST(r_regionkey AS BIGINT) AS "bizChannelId", p_name AS text
FROM lineitem JOIN region ON l_linenumber = r_regionkey JOIN part ON l_partkey = p_partkey""",
)
def kakao_keywords(spark, sf_dir):
    landed = read(spark, sf_dir, "lineitem").select(
        F.struct(F.col("l_linenumber").alias("adGroupId"), F.col("l_partkey").alias("keywordId"), F.col("l_suppkey").alias("campaignId")).alias("dimensions"),
        F.struct(F.col("l_quantity").alias("impression")).alias("metrics"),
    )
    channels = read(spark, sf_dir, "region").selectExpr(
        "CAST(r_regionkey AS INT) AS adGroupId", "CAST(r_regionkey AS BIGINT) AS id", "r_name AS name", "'x' AS talkChannels"
    )
    keywords = read(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_name AS text")
    return jn.kakao_keywords(landed, channels, keywords, drop=["talkChannels", "campaignId"])


TW = {
    "metricsImpressions": ["p_size", "CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_partkey END", "p_size + 1"],
    "metricsEngagements": ["CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size END", "CASE WHEN p_size % 3 = 0 THEN NULL ELSE 2 END", "NULL"],
}
TW_STATS = " UNION ALL ".join(
    f"SELECT p_partkey AS \"statId\", strftime(TIMESTAMP '2024-01-30' + INTERVAL {d} DAY, '%Y-%m-%d') AS \"segmentDate\", "
    + ", ".join(f'CAST({v[d]} AS DOUBLE) AS "{m}"' for m, v in TW.items()) + " FROM part"
    for d in range(3)
)


@query(
    "c14_promoted_tweets",
    f"""WITH s AS (SELECT "statId", "segmentDate", COALESCE("metricsImpressions", 0) AS "metricsImpressions", COALESCE("metricsEngagements", 0) AS "metricsEngagements"
  FROM ({TW_STATS}) WHERE "metricsImpressions" IS NOT NULL OR "metricsEngagements" IS NOT NULL),
j AS (SELECT DISTINCT s.*, CAST(p_partkey % 10 AS BIGINT) AS "tweetId", p_size AS "lineItemId", s_name AS name, n_name AS "lineItemName", n_regionkey AS "campaignId", r_name AS "campaignName"
  FROM s JOIN part ON "statId" = p_partkey JOIN supplier ON p_partkey % 10 = s_suppkey JOIN nation ON p_size = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY "metricsImpressions", "metricsEngagements" ORDER BY "statId", "segmentDate", "tweetId", "lineItemId", "campaignId") AS rn FROM j) WHERE rn = 1""",
)
def promoted_tweets(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    arrays = [F.array(*[F.expr(e).cast("long") for e in v]).alias(m) for m, v in (("impressions", TW["metricsImpressions"]), ("engagements", TW["metricsEngagements"]))]
    stats = part.select(F.col("p_partkey").alias("id"), F.array(F.struct(F.struct(*arrays).alias("metrics"))).alias("id_data"))
    daily = jn.tweet_stats(stats, {"metricsImpressions": "impressions", "metricsEngagements": "engagements"}, "2024-01-30")
    out = jn.promoted_tweets(
        part.selectExpr("p_partkey AS statId", "p_size AS lineItemId", "CAST(p_partkey % 10 AS BIGINT) AS tweetId"),
        read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS tweetId", "s_name AS name"),
        daily,
        read(spark, sf_dir, "nation").selectExpr("n_nationkey AS lineItemId", "n_name AS lineItemName", "n_regionkey AS campaignId"),
        read(spark, sf_dir, "region").selectExpr("r_regionkey AS campaignId", "r_name AS campaignName"),
    )
    return out.withColumn("segmentDate", F.col("segmentDate").cast("string"))


@query(
    "c15_organic_tweets",
    """SELECT p_partkey * 1000 AS "tweetId", p_name AS "campaignName", p_size AS "metricsImpressions", p_retailprice AS "metricsBilledChargeLocalMicro",
  s_name AS "creativeName", CAST(s_nationkey AS VARCHAR) AS "createdAt" FROM part JOIN supplier ON p_partkey = s_suppkey""",
)
def organic_tweets(spark, sf_dir):
    sheet = read(spark, sf_dir, "part").selectExpr(
        "concat(CAST(p_partkey AS STRING), 'E3') AS `트윗 ID`", "p_name AS `캠페인 이름`", "p_size AS `노출수`",
        "p_retailprice AS `비용`", "CAST(NULL AS STRING) AS `동영상 조회`",
    )
    mapping = read(spark, sf_dir, "supplier").selectExpr(
        "CAST(s_nationkey AS STRING) AS `최초 라이브`", "s_name AS `Campaign name`", "s_name AS `Creative name`",
        "concat(CAST(s_suppkey AS STRING), 'E3') AS `Tweet ID`", "CAST(NULL AS INT) AS memo",
    )
    table = f"{temp_database(spark, 'organic')}.{table_name('twt', 'main', 'organic')}"
    sk.overwrite(jn.organic_tweets(sheet, mapping), table)
    return spark.table(table)


CRITEO = {
    "Ad": "concat('ad ', CAST(l_suppkey AS STRING))", "Campaign": "concat('campaign ', CAST(o_custkey % 50 AS STRING))",
    "Adset": "CAST(l_partkey % 40 AS STRING)", "Device": "CAST(l_linenumber AS STRING)", "Channel": "l_returnflag",
    "Day": "CAST(CAST(l_shipdate AS DATE) AS STRING)", "Clicks": "CAST(l_quantity AS BIGINT)", "Displays": "CAST(l_quantity * 10 AS BIGINT)", "AdvertiserCost": "l_extendedprice",
}


def _criteo(spark, sf_dir, lines=None):
    lines = _lines(spark, sf_dir) if lines is None else lines
    return lines.select(*[F.expr(e).alias(n) for n, e in CRITEO.items()], F.lit("x").alias("extra"))


TWO_DAYS = preset(AS_OF, ch.CRITEO.window)
CRITEO_COLS = ", ".join(f'{e} AS "{n}"' for n, e in CRITEO.items())


@query("c16_criteo", f"SELECT {CRITEO_COLS} FROM {JOINED} WHERE {CRITEO['Day']} >= '{TWO_DAYS.first_day}' AND {CRITEO['Day']} <= '{TWO_DAYS.last_day}'")
def criteo(spark, sf_dir):
    return normalize_report(_criteo(spark, sf_dir), ch.CRITEO, TWO_DAYS)


AIR = {m: f"CASE WHEN user_id % {i + 3} = 0 THEN NULL ELSE event_id % {i + 10} END" for i, m in enumerate(ch.AIRBRIDGE_METRICS)}
AIR_BASE = "SELECT CAST(CAST(ts AS DATE) AS STRING) AS event_date, event_type AS channel"


def _camel_sql(name):
    head, *rest = name.split("_")
    return head + "".join(r.title() for r in rest)


@query(
    "c17_airbridge_stats",
    f"{AIR_BASE.replace('event_date', chr(34) + 'eventDate' + chr(34))}, " + ", ".join(f'COALESCE({e}, 0) AS "{_camel_sql(m)}"' for m, e in AIR.items()) + " FROM events",
)
def airbridge_stats(spark, sf_dir):
    landed = read(spark, sf_dir, "events").selectExpr(
        "CAST(CAST(ts AS DATE) AS STRING) AS event_date", "event_type AS channel", *[f"{e} AS {m}" for m, e in AIR.items()]
    )
    return jn.airbridge_stats(landed)


@query("c17_airbridge_raw", "SELECT event_id AS \"EventId\", event_type AS \"EventCategory\", CAST(CAST(ts AS DATE) AS STRING) AS \"EventDate\" FROM events")
def airbridge_raw(spark, sf_dir):
    from adflow.session import work_dir

    path = work_dir(spark, "airbridge")
    read(spark, sf_dir, "events").selectExpr(
        "event_id AS `Event Id`", "event_type AS `Event Category`", "CAST(CAST(ts AS DATE) AS STRING) AS `Event Date`"
    ).write.option("header", True).csv(path)
    from pyspark.sql import types as T

    return rd.read_csv(spark, path, T.StructType.fromDDL("`Event Id` bigint, `Event Category` string, `Event Date` string"))


@query("c18_branch_exports", "SELECT CAST(event_id AS VARCHAR) AS id, event_type AS name FROM events")
def branch_exports(spark, sf_dir):
    from adflow.session import work_dir

    base = work_dir(spark, "branch")
    raw = read(spark, sf_dir, "events").selectExpr("event_id AS id", "event_type AS name", "value AS revenue")
    raw.where("id % 2 = 0").write.option("header", True).csv(f"{base}/export_0")
    raw.where("id % 2 = 1").write.option("header", True).csv(f"{base}/export_1")
    fields = spark.createDataFrame([("id", "y", "y"), ("name", "y", "n"), ("revenue", "n", "y")], "dimension string, click string, install string")
    return jn.export_fields(rd.read_csv(spark, f"{base}/export_*"), fields, "click")


# Written out from the tables, not from the specs: channel, grain and unit are what is checked.
FACT_SQL = """
SELECT strftime(l_shipdate, '%Y-%m-%d') AS "date", 'google_ad' AS channel, 'main' AS advertiser, CAST(o_custkey % 50 AS VARCHAR) AS campaign,
  CAST(l_partkey % 40 AS VARCHAR) AS adgroup, CAST(l_suppkey AS VARCHAR) AS ad, CAST(l_quantity * 10 AS BIGINT) AS impressions, CAST(l_quantity AS BIGINT) AS clicks,
  CASE WHEN l_linenumber = 1 THEN 0 ELSE CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * 10000 AS DOUBLE) / 1000000 END AS cost,
  CAST(round(l_discount * 100) AS DOUBLE) AS conversions FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL
SELECT strftime(l_shipdate, '%Y-%m-%d'), 'facebook_ad', 'main', CAST(o_custkey % 50 AS VARCHAR), CAST(l_partkey % 40 AS VARCHAR), CAST(l_suppkey AS VARCHAR),
  CAST(l_quantity * 10 AS BIGINT), CASE l_returnflag WHEN 'R' THEN CAST(l_quantity AS BIGINT) + 1 WHEN 'A' THEN 0 ELSE CAST(l_quantity AS BIGINT) END,
  CAST(round(l_extendedprice) AS DOUBLE), NULL FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL
SELECT strftime(l_shipdate, '%Y-%m-%d'), 'criteo', 'main', 'campaign ' || CAST(o_custkey % 50 AS VARCHAR), CAST(l_partkey % 40 AS VARCHAR), 'ad ' || CAST(l_suppkey AS VARCHAR),
  CAST(l_quantity * 10 AS BIGINT), CAST(l_quantity AS BIGINT), l_extendedprice, NULL FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL
SELECT strftime(l_shipdate, '%Y-%m-%d'), 'kakao', 'main', CAST(n_regionkey AS VARCHAR), CAST(s_nationkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
  NULL, CAST(l_quantity AS BIGINT), l_extendedprice, NULL
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT "segmentDate", 'twitter', 'main', CAST("campaignId" AS VARCHAR), CAST("lineItemId" AS VARCHAR), CAST("tweetId" AS VARCHAR),
  CAST("metricsImpressions" AS BIGINT), NULL, NULL, NULL FROM (""" + ORACLES["c14_promoted_tweets"] + """)
UNION ALL
SELECT NULL, 'twitterorganic', 'main', p_name, NULL, CAST(p_partkey * 1000 AS VARCHAR), p_size, NULL, p_retailprice / 1000000, NULL
  FROM part JOIN supplier ON p_partkey = s_suppkey
UNION ALL
SELECT CAST(CAST(ts AS DATE) AS VARCHAR), 'airbridge', 'main', event_type, NULL, NULL, CASE WHEN user_id % 3 = 0 THEN 0 ELSE event_id % 10 END,
  CASE WHEN user_id % 4 = 0 THEN 0 ELSE event_id % 11 END, CASE WHEN user_id % 7 = 0 THEN 0 ELSE event_id % 14 END,
  CASE WHEN user_id % 11 = 0 THEN 0 ELSE event_id % 18 END FROM events"""


@query("c19_cross_channel_fact", FACT_SQL)
def cross_channel_fact(spark, sf_dir):
    """Every channel at its finest grain, cost in whole units. The rows that three channels have
    landed in are joined once."""
    lines = staged(_lines(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_linestatus", "l_shipdate", "o_custkey"), "landed")
    return union_facts([
        (normalize_report(google_landed(spark, sf_dir, lines), ch.GOOGLE_AD), ch.GOOGLE_AD),
        (normalize_report(facebook_landed(spark, sf_dir, lines), ch.FACEBOOK_AD), ch.FACEBOOK_AD),
        (normalize_report(_criteo(spark, sf_dir, lines), ch.CRITEO), ch.CRITEO),
        (kakao_creatives(spark, sf_dir), ch.KAKAO_FACT),
        (promoted_tweets(spark, sf_dir), ch.TWITTER_FACT),
        (organic_tweets(spark, sf_dir), ch.TWITTER_ORGANIC_FACT),
        (airbridge_stats(spark, sf_dir), ch.AIRBRIDGE_FACT),
    ], "main")
