"""Training features."""

from __future__ import annotations

from pyspark.sql import functions as F

from adflow.operators import features as ft
from adflow.operators import funnel as fn
from adflow.operators.skew import fanout_left_join
from adflow.plans.funnel_queries import DAY_ROWS, _day_rows
from adflow.plans.registry import query
from adflow.plans.scalar_queries import CATEGORY, CATEGORY_SQL, OS_SQL, REGION_SQL
from adflow.plans.views import FULL, HEAD, REQUEST, bronze, flat_sql, read

START, END = "2024-01-05", "2024-01-25"
# Category text per bundle: the spellings of the scalar query, by bundle number.
APP_SQL = f"SELECT DISTINCT {REQUEST['bundle']} AS bundle, user_id % 17 AS user_id FROM events"


def _apps(spark, sf_dir):
    number = read(spark, sf_dir, "events").selectExpr("user_id % 17 AS user_id").distinct()
    return number.selectExpr(f"{REQUEST['bundle']} AS bundle", f"{CATEGORY} AS category")


def _features(spark, sf_dir):
    return ft.bid_features(
        _day_rows(spark, sf_dir), bronze(spark, sf_dir, "bid"), _apps(spark, sf_dir), START, END
    )


REQ_SQL = flat_sql("bid", {
    "tid": HEAD["tid"], "bundle": REQUEST["bundle"], "bidfloor": REQUEST["bidfloor"],
    "deviceType": REQUEST["devicetype"], "os": OS_SQL, "region": f"replace({REGION_SQL}, 'KR-', '')",
}, f"AND CAST(ts AS DATE) BETWEEN DATE '{START}' AND DATE '{END}'")
FEATURE_SQL = f"""{DAY_ROWS}, req AS ({REQ_SQL}), apps AS (SELECT bundle, {CATEGORY_SQL} AS cat FROM ({APP_SQL})),
feat AS (SELECT rows."Date" AS "Date", rows."DeviceId" AS "DeviceId", rows.tid AS tid, '1' AS bid,
  CASE WHEN imptime IS NOT NULL THEN '1' ELSE '0' END AS imp,
  CASE WHEN imptime IS NOT NULL AND clktime IS NOT NULL THEN '1' ELSE '0' END AS clk,
  CASE WHEN "Height" = 480 THEN '1' ELSE '2' END AS size, bidfloor, NULLIF(cat, '') AS "appCategory", "deviceType", os, region
FROM rows LEFT JOIN req ON rows.tid = req.tid AND rows."Date" BETWEEN DATE '{START}' AND DATE '{END}' LEFT JOIN apps ON req.bundle = apps.bundle)"""


@query("m1_bid_features", f"{FEATURE_SQL} SELECT * FROM feat")
def bid_features(spark, sf_dir):
    return _features(spark, sf_dir)


@query(
    "j14_with_request",
    f"""{DAY_ROWS}, req AS ({REQ_SQL}) SELECT rows.tid AS tid, rows."Date" AS "Date", req."deviceType" AS "deviceType", req.bundle AS bundle
FROM rows LEFT JOIN req ON rows.tid = req.tid AND rows."Date" BETWEEN DATE '{START}' AND DATE '{END}'""",
)
def with_request(spark, sf_dir):
    requests = ft.request_attributes(bronze(spark, sf_dir, "bid").where(
        F.col("actiontime_date").between(F.lit(START).cast("date"), F.lit(END).cast("date"))
    ))
    return ft.with_request(_day_rows(spark, sf_dir), requests, START, END).select("tid", "Date", "deviceType", "bundle")


@query(
    "j13_with_category",
    f"SELECT b.tid, b.ts AS t, {CATEGORY_SQL.replace('user_id', 'b.n')} AS \"appCategory\" FROM (SELECT {HEAD['tid']} AS tid, ts, user_id % 17 AS n FROM events WHERE event_type = 'view') b",
)
def with_category(spark, sf_dir):
    bids = bronze(spark, sf_dir, "bid").select("tid", F.col("actiontime_local").alias("t"), F.col("BidStream.bundle_domain").alias("bundle"))
    return ft.with_category(bids, _apps(spark, sf_dir)).select("tid", "t", "appCategory")


DMP_SQL = "SELECT concat('d', CAST(c_custkey AS STRING)) AS uuid, CASE WHEN c_nationkey = 0 THEN 'OTHER' ELSE 'ADID' END AS id_type, CAST(c_custkey % 2 AS STRING) AS gender_code, concat(CAST(c_nationkey AS STRING), '0s') AS age_range, c_mktsegment AS carrier FROM customer"
WEB_SQL = f"""SELECT CAST(ts AS DATE) AS "Date", {HEAD['tid']} AS tid, {FULL['DeviceId']} AS "DeviceId", user_id % 2 AS "newUser", event_id AS session_duration,
  CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS request_event, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 0 END AS call_event FROM events WHERE event_type = 'signup'"""


@query(
    "m2_training_set",
    f"""{FEATURE_SQL}, dmp AS ({DMP_SQL}), web AS ({WEB_SQL})
SELECT feat.tid AS tid, feat."DeviceId" AS "DeviceId", feat."Date" AS "Date", CAST(dayofweek(feat."Date") + 1 AS VARCHAR) AS dow, imp, clk, size, bidfloor, "appCategory", os,
  gender_code AS gender, age_range AS age, carrier, CASE WHEN "newUser" > 0 THEN '1' ELSE CAST("newUser" AS VARCHAR) END AS "newUser", session_duration,
  CASE WHEN web.tid IS NULL THEN 2.0::DOUBLE WHEN request_event > 0 OR COALESCE(call_event, 0) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS cv
FROM feat LEFT JOIN (SELECT * FROM dmp WHERE id_type = 'ADID') ON feat."DeviceId" = uuid LEFT JOIN web ON feat.tid = web.tid AND feat."DeviceId" = web."DeviceId" """,
)
def training_set(spark, sf_dir):
    return _training(spark, sf_dir).select(
        "tid", "DeviceId", "Date", "dow", "imp", "clk", "size", "bidfloor", "appCategory", "os", "gender",
        "age", "carrier", "newUser", "session_duration", "cv",
    )


def _training(spark, sf_dir):
    dmp = read(spark, sf_dir, "customer").selectExpr(
        "concat('d', CAST(c_custkey AS STRING)) AS uuid", "CASE WHEN c_nationkey = 0 THEN 'OTHER' ELSE 'ADID' END AS id_type",
        "CAST(c_custkey % 2 AS STRING) AS gender_code", "concat(CAST(c_nationkey AS STRING), '0s') AS age_range", "c_mktsegment AS carrier",
    )
    web = read(spark, sf_dir, "events").where("event_type = 'signup'").selectExpr(
        "CAST(ts AS DATE) AS Date", f"{HEAD['tid']} AS tid", f"{FULL['DeviceId']} AS DeviceId", "user_id % 2 AS newUser",
        "event_id AS session_duration", "CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS request_event",
        "CASE WHEN event_id % 3 = 0 THEN NULL ELSE 0 END AS call_event",
    )
    days = ft.labelled_days(web, ["request_event", "call_event"])
    return ft.training_set(_features(spark, sf_dir), dmp, days)


@query(
    "j15_fanout_join",
    """SELECT o_orderkey, o_orderstatus, l_partkey, l_linenumber, l_quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
)
def fanout_join(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_linenumber", "l_quantity")
    return fanout_left_join(orders, lines, ["o_orderkey"], salts=4, share=0.0002)


@query(
    "m4_low_cardinality",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(DISTINCT {c}) AS \"distinct\", COUNT(DISTINCT {c}) <= 100 AS keep FROM customer"
        for c in ("c_name", "c_mktsegment")
    ),
)
def low_cardinality(spark, sf_dir):
    return ft.low_cardinality(read(spark, sf_dir, "customer"), 100)


@query(
    "m5_fill_missing",
    "SELECT event_id, COALESCE(CASE WHEN event_type = 'view' THEN NULL ELSE event_type END, 'missing') AS kind FROM events",
)
def fill_missing(spark, sf_dir):
    rows = read(spark, sf_dir, "events").selectExpr("event_id", "CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS kind")
    return ft.fill_missing(rows, ["kind"])


GAPS = {"quantity": "CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_quantity AS BIGINT) END", "line": "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber END"}


@query(
    "m7_impute_mean",
    "SELECT l_orderkey, l_partkey, "
    + ", ".join(f"COALESCE(CAST({e} AS DOUBLE), (SELECT CAST(SUM({e}) AS DOUBLE) / COUNT({e}) FROM lineitem)) AS {n}_imputed" for n, e in GAPS.items())
    + " FROM lineitem",
)
def impute_mean(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_partkey", *[f"{e} AS {n}" for n, e in GAPS.items()])
    return ft.impute_mean(rows, list(GAPS)).drop(*GAPS)


POINT_SQL = "CAST(concat('0x', substr(md5(concat('7|', CAST(o_orderkey AS STRING))), 1, 8)) AS BIGINT) % 10000"


@query(
    "m11_split",
    f"SELECT o_orderkey, CASE WHEN {POINT_SQL} < 7000 THEN 'train' ELSE 'test' END AS part FROM orders",
)
def split(spark, sf_dir):
    train, test = ft.split(read(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], [0.7, 0.3], seed=7)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
