"""Set operations, semi and anti joins, de-duplication and look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from adflow.operators import dedup as dd
from adflow.operators import sets as st
from adflow.operators.skew import skew_join
from adflow.plans.registry import query
from adflow.plans.views import FULL, HEAD, REPORT_SQL, REQUEST, bronze, flat_sql, read, report

FACT = ["segmentsDate", "campaignId", "adgroupId", "adId", "impressions", "clicks", "costMicros", "status"]
KEYS = ["segmentsDate", "campaignId", "adgroupId", "adId"]
FACT_SQL = f"SELECT {', '.join(FACT)} FROM ({REPORT_SQL})"
WASH_SQL = f"""SELECT segmentsDate, campaignId, adgroupId, adId, CAST(SUM(impressions + 1) AS BIGINT) AS impressions,
  CAST(SUM(clicks + 1) AS BIGINT) AS clicks FROM ({FACT_SQL}) WHERE status = 'R' GROUP BY ALL"""


def _fact(spark, sf_dir):
    return report(spark, sf_dir).select(*FACT)


def _wash(spark, sf_dir):
    returned = _fact(spark, sf_dir).where("status = 'R'")
    return returned.groupBy(*KEYS).agg(
        F.sum(F.col("impressions") + 1).alias("impressions"),
        F.sum(F.col("clicks") + 1).alias("clicks"),
    )


KEY_MATCH = " AND ".join(f"r.{k} = w.{k}" for k in KEYS)


@query("j7_semi", f"SELECT * FROM ({FACT_SQL}) r WHERE EXISTS (SELECT 1 FROM ({WASH_SQL}) w WHERE {KEY_MATCH})")
def semi(spark, sf_dir):
    return st.semi(_fact(spark, sf_dir), _wash(spark, sf_dir), KEYS).select(*FACT)


@query("j8_anti", f"SELECT * FROM ({FACT_SQL}) r WHERE NOT EXISTS (SELECT 1 FROM ({WASH_SQL}) w WHERE {KEY_MATCH})")
def anti(spark, sf_dir):
    return st.anti(_fact(spark, sf_dir), _wash(spark, sf_dir), KEYS).select(*FACT)


@query("j8_anti_null_aware", "SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def anti_null_aware(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return st.anti(read(spark, sf_dir, "orders"), lines, ["o_orderkey"], null_aware=True)


@query(
    "d5_overlay",
    f"""WITH raw AS ({FACT_SQL}), wash AS ({WASH_SQL})
SELECT r.segmentsDate, r.campaignId, r.adgroupId, r.adId, r.status, w.impressions, w.clicks
FROM (SELECT DISTINCT segmentsDate, campaignId, adgroupId, adId, status FROM raw) r JOIN wash w ON {KEY_MATCH}
UNION ALL
SELECT r.segmentsDate, r.campaignId, r.adgroupId, r.adId, r.status, r.impressions, r.clicks FROM raw r
WHERE NOT EXISTS (SELECT 1 FROM wash w WHERE {KEY_MATCH})""",
)
def overlay(spark, sf_dir):
    return st.overlay(_fact(spark, sf_dir), _wash(spark, sf_dir), KEYS, ["status"], ["impressions", "clicks"])


@query(
    "j16_new_ids",
    "SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_returnflag = 'N' AND l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
)
def new_ids(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "id")
    return st.new_ids(lines.where("l_returnflag = 'N'"), lines.where("l_returnflag = 'R'"), "id")


DOM_SQL = flat_sql("imp", {"domain": FULL["url"], "requestType": REQUEST["bidrequest_type"], "day": "CAST(ts AS DATE)"})


def _domains(spark, sf_dir):
    return bronze(spark, sf_dir, "imp").select(
        F.col("BidStream.bundle_domain").alias("domain"),
        F.col("BidStream.bidrequest_type").alias("requestType"),
        F.col("actiontime_date").alias("day"),
    )


def _split_domains(spark, sf_dir, day="2024-01-02"):
    rows = _domains(spark, sf_dir)
    known = rows.where(F.col("day") < F.lit(day).cast("date")).select("domain", "requestType")
    today = rows.where(F.col("day") >= F.lit(day).cast("date")).select("domain", "requestType")
    return known, today


@query("e1_union_all", "SELECT event_id, ts FROM events WHERE event_type = 'view' UNION ALL SELECT event_id, ts FROM events WHERE value > 50")
def union_all(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    return st.append_rows(
        events.where("event_type = 'view'").select("event_id", "ts"),
        events.where("value > 50").select("ts", "event_id"),
    )


@query("e2_merge_domains", f"SELECT DISTINCT domain, requestType FROM ({DOM_SQL})")
def merge_domains(spark, sf_dir):
    return st.merge_domains(*_split_domains(spark, sf_dir))


@query(
    "e3_union_distinct",
    "SELECT event_type, user_id FROM events WHERE value = 0 UNION SELECT event_type, user_id FROM events WHERE value <> 0",
)
def union_distinct(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    cols = ("event_type", "user_id")
    return st.merge_domains(events.where("value = 0").select(*cols), events.where("value <> 0").select(*cols))


@query(
    "e4_new_domains",
    f"SELECT DISTINCT domain, requestType FROM ({DOM_SQL}) WHERE day >= DATE '2024-01-02' EXCEPT SELECT domain, requestType FROM ({DOM_SQL}) WHERE day < DATE '2024-01-02'",
)
def new_domains(spark, sf_dir):
    return st.new_domains(*_split_domains(spark, sf_dir))


@query("d1_distinct_rows", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_rows(spark, sf_dir):
    return dd.distinct_rows(read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))


METRIC_SQL = f"SELECT adId, segmentsDate, impressions AS metricsImpressions, clicks AS metricsClicks, conversions AS metricsConversions FROM ({REPORT_SQL})"


@query(
    "d2_dedup_on_metrics",
    f"""SELECT adId, segmentsDate, metricsImpressions, metricsClicks, metricsConversions FROM (
  SELECT *, row_number() OVER (PARTITION BY metricsImpressions, metricsClicks, metricsConversions ORDER BY adId, segmentsDate) AS rn
  FROM ({METRIC_SQL})) WHERE rn = 1""",
)
def dedup_on_metrics(spark, sf_dir):
    rows = report(spark, sf_dir).select(
        "adId", "segmentsDate", F.col("impressions").alias("metricsImpressions"),
        F.col("clicks").alias("metricsClicks"), F.col("conversions").alias("metricsConversions"),
    )
    return dd.dedup_on(rows, "metrics", ["adId", "segmentsDate"])


@query("d3_drop_duplicates", f"SELECT DISTINCT campaignId, adgroupId, adId, status FROM ({REPORT_SQL})")
def drop_duplicates(spark, sf_dir):
    return report(spark, sf_dir).select("campaignId", "adgroupId", "adId", "status").dropDuplicates()


BID_SQL = flat_sql("bid", {"tid": HEAD["tid"], "DeviceId": FULL["DeviceId"], "url": FULL["url"], "hour": HEAD["actiontime_hour"]})


@query(
    "d4_dup_report",
    f"""WITH b AS ({BID_SQL}), t AS (SELECT tid, DeviceId, url, hour, COUNT(*) AS tuple_rows FROM b GROUP BY ALL),
k AS (SELECT tid, COUNT(*) AS "rows", COUNT(DISTINCT (DeviceId, url, hour)) AS variants FROM b GROUP BY tid HAVING COUNT(*) > 1)
SELECT t.tid, DeviceId, url, hour, tuple_rows, "rows", variants FROM t JOIN k ON t.tid = k.tid""",
)
def dup_report(spark, sf_dir):
    bids = bronze(spark, sf_dir, "bid").select(
        "tid", "BidStream.DeviceId", F.col("BidStream.bundle_domain").alias("url"),
        F.col("actiontime_hour").alias("hour"),
    )
    return dd.dup_report(bids, "tid", ["DeviceId", "url", "hour"])


@query(
    "j9_enrich_chain",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice, o_orderpriority, p_brand, s_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
)
def enrich_chain(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey")
    dims = [
        (read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), ["l_partkey"]),
        (read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), ["l_suppkey"]),
        (read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), ["l_orderkey"]),
    ]
    return st.enrich(lines, dims).drop("l_partkey", "l_suppkey")


@query(
    "j10_report_lookup",
    f"""SELECT DISTINCT r.segmentsDate, r.adId, r.status, s_name AS creativeName FROM ({REPORT_SQL}) r JOIN supplier ON adId = s_suppkey""",
)
def report_lookup(spark, sf_dir):
    names = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("adId"), F.col("s_name").alias("creativeName"))
    rows = st.enrich(report(spark, sf_dir), [(names, ["adId"])])
    return rows.select("segmentsDate", "adId", "status", "creativeName").dropDuplicates()


@query(
    "j11_left_metric",
    f"""WITH r AS ({REPORT_SQL}), f AS (SELECT DISTINCT campaignId, adgroupId, segmentsDate FROM r),
a AS (SELECT campaignId, adgroupId, segmentsDate, CAST(SUM(conversions) AS BIGINT) AS installs FROM r WHERE status = 'R' GROUP BY ALL HAVING SUM(conversions) > 0)
SELECT f.campaignId, f.adgroupId, f.segmentsDate, installs FROM f LEFT JOIN a ON f.campaignId = a.campaignId AND f.adgroupId = a.adgroupId AND f.segmentsDate = a.segmentsDate""",
)
def left_metric(spark, sf_dir):
    rows = report(spark, sf_dir)
    keys = ["campaignId", "adgroupId", "segmentsDate"]
    detail = rows.where("status = 'R'").select(*keys, F.col("conversions").alias("installs"))
    return st.left_metric(rows.select(*keys).distinct(), detail, keys, "installs")


@query(
    "j12_left_lookup",
    "SELECT p_partkey, p_brand, s_suppkey, s_name FROM part LEFT JOIN supplier ON p_partkey = s_suppkey",
)
def left_lookup(spark, sf_dir):
    return st.left_lookup(
        read(spark, sf_dir, "part").select("p_partkey", "p_brand"),
        read(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "p_partkey", "s_suppkey",
    )


@query(
    "j19_campaign_scope",
    f"""SELECT segmentsDate, campaignId, adId, impressions FROM ({REPORT_SQL})
WHERE campaignId IN (SELECT DISTINCT CAST(c_custkey % 50 AS BIGINT) FROM customer WHERE c_mktsegment IN ('BUILDING'))""",
)
def campaign_scope(spark, sf_dir):
    campaigns = read(spark, sf_dir, "customer").select(
        F.expr("CAST(c_custkey % 50 AS BIGINT) AS campaignId"), F.col("c_mktsegment").alias("campaignType")
    )
    rows = report(spark, sf_dir).select("segmentsDate", "campaignId", "adId", "impressions")
    return st.scope(rows, campaigns, ["BUILDING"])


@query(
    "j18_match_counts",
    """WITH a AS (SELECT l_suppkey AS id, COUNT(*) AS rows_a FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL),
b AS (SELECT l_suppkey AS id, COUNT(*) AS rows_b FROM lineitem WHERE l_returnflag = 'N' GROUP BY ALL)
SELECT a.id, rows_a, rows_b, rows_a * rows_b AS pairs FROM a JOIN b ON a.id = b.id""",
)
def match_counts(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    return st.match_counts(lines.where("l_returnflag = 'R'"), lines.where("l_returnflag = 'N'"), "l_suppkey", "l_suppkey")


@query(
    "j13_skewed_lookup",
    """SELECT event_id, user_id, label FROM events LEFT JOIN (
  SELECT doc_id, concat('q', CAST(quality AS STRING)) AS label FROM labels) ON user_id = doc_id""",
)
def skewed_lookup(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_id", "user_id")
    labels = read(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("user_id"), F.concat(F.lit("q"), F.col("quality").cast("string")).alias("label")
    )
    return skew_join(events, labels, ["user_id"], "left", salts=8, share=0.005)


@query(
    "q8_reconcile",
    """WITH a AS (SELECT l_shipdate AS d, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q_a, COUNT(*) AS n_a FROM lineitem WHERE l_returnflag <> 'N' GROUP BY ALL),
b AS (SELECT l_shipdate AS d, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q_b, COUNT(*) AS n_b FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL)
SELECT COALESCE(a.d, b.d) AS d, q_a, q_b, n_a, n_b, COALESCE(q_a, 0) - COALESCE(q_b, 0) AS q_diff, COALESCE(n_a, 0) - COALESCE(n_b, 0) AS n_diff,
  greatest(abs(COALESCE(q_a, 0) - COALESCE(q_b, 0)), abs(COALESCE(n_a, 0) - COALESCE(n_b, 0))) <= 5 AS agrees
FROM a FULL JOIN b ON a.d = b.d""",
)
def reconcile(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("d"), F.col("l_quantity").cast("long").alias("q"), F.lit(1).cast("long").alias("n"),
        "l_returnflag", "l_linestatus",
    )
    return st.reconcile(lines.where("l_returnflag <> 'N'"), lines.where("l_linestatus = 'F'"), ["d"], ["q", "n"], 5)
