"""Scalar functions, code tables and filters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from adflow.functions import recode as rc
from adflow.functions import scalars as sc
from adflow.functions import timewin as tw
from adflow.operators import filters as fl
from adflow.plans.registry import query
from adflow.plans.views import FULL, REPORT_SQL, REQUEST, read, report

AS_OF = datetime(2024, 1, 20, 12, 33)


def _events(spark, sf_dir):
    return read(spark, sf_dir, "events")


@query(
    "x1_time_bucket",
    "SELECT event_id, time_bucket(INTERVAL 5 MINUTE, ts) AS bucket5, time_bucket(INTERVAL 30 MINUTE, ts) AS bucket30 FROM events",
)
def time_bucket(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id", tw.time_bucket(F.col("ts"), 5).alias("bucket5"),
        tw.time_bucket(F.col("ts"), 30).alias("bucket30"),
    )


@query(
    "x2_truncate",
    """SELECT event_id, date_trunc('hour', ts) AS hour_start, date_trunc('day', ts) AS day_start,
  CAST(CAST(ts AS DATE) AS STRING) AS day, CAST(hour(ts) AS INT) AS hour FROM events""",
)
def truncate(spark, sf_dir):
    ts = F.col("ts")
    return _events(spark, sf_dir).select(
        "event_id", tw.hour_of(ts).alias("hour_start"), tw.time_bucket(ts, 1440).alias("day_start"),
        tw.day_of(ts).cast("string").alias("day"), F.hour(ts).alias("hour"),
    )


@query(
    "x3_seconds_between",
    """SELECT l_orderkey, l_linenumber, CAST(trunc((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 1000000.0) AS BIGINT) AS seconds
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def seconds_between(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber",
        tw.between_seconds(F.col("o_orderdate"), F.col("l_shipdate")).alias("seconds"),
    )


@query(
    "x4_day_of_week",
    "SELECT o_orderkey, CAST(dayofweek(o_orderdate) + 1 AS INT) AS dow FROM orders",
)
def day_of_week(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", F.dayofweek("o_orderdate").alias("dow"))


@query("x5_month", "SELECT o_orderkey, CAST(month(o_orderdate) AS INT) AS month FROM orders")
def month(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", F.month("o_orderdate").alias("month"))


@query("x6_clock_time", "SELECT event_id, strftime(ts, '%H:%M:%S') AS clock FROM events")
def clock_time(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", tw.clock_time(F.col("ts")).alias("clock"))


# The windows written out by hand for AS_OF.
WINDOWS = {
    "5m": ("2024-01-20 12:25:00", "2024-01-20 12:30:00"),
    "1h": ("2024-01-20 11:00:00", "2024-01-20 12:00:00"),
    "1d": ("2024-01-19 00:00:00", "2024-01-20 00:00:00"),
    "yesterday": ("2024-01-19 00:00:00", "2024-01-20 00:00:00"),
    "wash_day": ("2024-01-12 00:00:00", "2024-01-13 00:00:00"),
    "three_weeks": ("2023-12-29 00:00:00", "2024-01-20 00:00:00"),
    "two_days": ("2024-01-18 00:00:00", "2024-01-20 00:00:00"),
    "last_week": ("2024-01-08 00:00:00", "2024-01-15 00:00:00"),
    "last_month": ("2023-12-01 00:00:00", "2024-01-01 00:00:00"),
    "since_last_month": ("2023-12-01 00:00:00", "2024-01-21 00:00:00"),
    "month_to_date": ("2024-01-01 00:00:00", "2024-01-21 00:00:00"),
}


def _window_sql(names):
    cols = ", ".join(
        f"COUNT(*) FILTER (WHERE ts >= TIMESTAMP '{WINDOWS[n][0]}' AND ts < TIMESTAMP '{WINDOWS[n][1]}') AS w_{n}"
        for n in names
    )
    return f"SELECT event_type, {cols} FROM events GROUP BY event_type"


def _window_counts(df, windows):
    return df.groupBy("event_type").agg(
        *[F.count_if(w.holds(F.col("ts"))).alias(f"w_{n}") for n, w in windows.items()]
    )


@query("x7_criteria_windows", _window_sql(tw.GRAINS))
def criteria_windows(spark, sf_dir):
    return _window_counts(_events(spark, sf_dir), {g: tw.criteria(AS_OF, g) for g in tw.GRAINS})


@query("o2_preset_windows", _window_sql(tw.PRESETS))
def preset_windows(spark, sf_dir):
    return _window_counts(_events(spark, sf_dir), {p: tw.preset(AS_OF, p) for p in tw.PRESETS})


@query(
    "x8_zero_if_null",
    "SELECT d.doc_id, COALESCE(quality, 0) AS quality, COALESCE(toxic, 0) AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
)
def zero_if_null(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id")
    labels = read(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", sc.zero_if_null(F.col("quality")).alias("quality"),
        sc.zero_if_null(F.col("toxic")).alias("toxic"),
    )


CATEGORY = (
    "CASE CAST(user_id % 8 AS INT) WHEN 0 THEN 'Books & Reference' WHEN 1 THEN 'Sports' WHEN 2 THEN '스포츠'"
    " WHEN 3 THEN 'Art & Design' WHEN 4 THEN '쇼핑' WHEN 5 THEN 'Some Thing' WHEN 6 THEN '' ELSE NULL END"
)
CATEGORY_SQL = (
    "CASE CAST(user_id % 8 AS INT) WHEN 0 THEN '1' WHEN 1 THEN '8' WHEN 2 THEN '19'"
    " WHEN 3 THEN '8' WHEN 4 THEN '17' WHEN 5 THEN 'SomeThing' WHEN 6 THEN '' ELSE NULL END"
)
REGION_SQL = (
    "CASE CAST(user_id % 12 AS INT) WHEN 0 THEN 'KR-11' WHEN 1 THEN 'KR-11' WHEN 2 THEN 'KR-26'"
    " WHEN 3 THEN 'KR-26' WHEN 4 THEN 'KR-0' WHEN 5 THEN 'KR-49' WHEN 7 THEN 'KR-11' WHEN 8 THEN 'KR-41'"
    " WHEN 9 THEN 'KR-49' WHEN 10 THEN 'KR-44' ELSE NULL END"
)
DEVICE_SQL = (
    f"CASE {REQUEST['devicetype']} "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rc.DEVICE_TYPE.items())
    + f" ELSE {REQUEST['devicetype']} END"
)
OS_SQL = (
    f"CASE WHEN ({REQUEST['os']}) IS NULL THEN NULL WHEN lower({REQUEST['os']}) = 'android' THEN '1'"
    f" WHEN lower({REQUEST['os']}) = 'ios' THEN '2' WHEN lower({REQUEST['os']}) = 'unknown' THEN '4' ELSE '3' END"
)


@query(
    "x9_recode",
    f"""SELECT event_id, {DEVICE_SQL} AS device, {CATEGORY_SQL} AS category, {REGION_SQL} AS region,
  {OS_SQL} AS os, CASE WHEN user_id % 2 = 1 THEN '1' ELSE '2' END AS size FROM events""",
)
def recode(spark, sf_dir):
    rows = _events(spark, sf_dir).select(
        "event_id", F.expr(REQUEST["devicetype"]).alias("dt"), F.expr(CATEGORY).alias("cat"),
        F.expr(REQUEST["region"]).alias("reg"), rc.os_class(F.lower(F.expr(REQUEST["os"]))).alias("os"),
        rc.size_class(F.expr(FULL["Width"]), F.expr(FULL["Height"])).alias("size"),
    )
    rows = rc.device_type(rows, "dt", "device")
    rows = rc.app_category(rows, "cat", "category")
    rows = rc.recode_region(rows, "reg", "region")
    return rows.select("event_id", "device", "category", "region", "os", "size")


def _labels_sql(labels, code):
    whens = " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(labels))
    return f"CASE {code} {whens} END"


@query(
    "x10_code_labels",
    f"""SELECT rowNo, adId, {_labels_sql(rc.SEGMENT_DEVICE, 'deviceCode')} AS device,
  {_labels_sql(rc.NETWORK_TYPE, 'networkType')} AS network, {_labels_sql(rc.PERFORMANCE_LEVEL, 'labelCode')} AS level
FROM ({REPORT_SQL})""",
)
def code_labels(spark, sf_dir):
    return report(spark, sf_dir).select(
        "rowNo", "adId", rc.by_position(F.col("deviceCode"), rc.SEGMENT_DEVICE).alias("device"),
        rc.by_position(F.col("networkType"), rc.NETWORK_TYPE).alias("network"),
        rc.by_position(F.col("labelCode"), rc.PERFORMANCE_LEVEL).alias("level"),
    )


@query(
    "x11_text_functions",
    f"""SELECT event_id, lower(event_type) AS low, replace(props, ' ', '') AS squeezed,
  regexp_replace({REGION_SQL}, 'KR-', '') AS region, substring(props, 2, 3) AS part FROM events""",
)
def text_functions(spark, sf_dir):
    rows = _events(spark, sf_dir).withColumn("reg", F.expr(REQUEST["region"]))
    return rc.recode_region(rows, "reg", "region").select(
        "event_id", F.lower("event_type").alias("low"),
        F.replace(F.col("props"), F.lit(" "), F.lit("")).alias("squeezed"),
        F.regexp_replace("region", "KR-", "").alias("region"),
        F.substring("props", 2, 3).alias("part"),
    )


@query(
    "x12_floor_price",
    "SELECT o_orderkey, o_totalprice AS price, o_totalprice >= 1000 AS has_comma_trap FROM orders",
)
def floor_price(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", F.round("o_totalprice", 12).alias("price"),
        (F.col("o_totalprice") >= 1000).alias("has_comma_trap"),
    )


@query("x13_number_text", f"SELECT event_id, CAST({REQUEST['lat']} AS STRING) AS lat FROM events")
def number_text(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", F.expr(REQUEST["lat"]).cast("string").alias("lat"))


@query(
    "x14_base64_names",
    "SELECT c_custkey, to_base64(encode(c_name)) AS encoded, c_name AS decoded FROM customer",
)
def base64_names(spark, sf_dir):
    encoded = read(spark, sf_dir, "customer").select(
        "c_custkey", F.base64(F.col("c_name").cast("binary")).alias("encoded")
    )
    return encoded.withColumn("decoded", sc.decode_base64(F.col("encoded")))


@query(
    "x15_micros",
    """SELECT o_orderkey, CAST(round_even(CAST(CAST(round(o_totalprice * 2) AS BIGINT) * 500000 AS DOUBLE) * 0.000001, 0) AS BIGINT) AS currency FROM orders""",
)
def micros(spark, sf_dir):
    cost = F.round(F.col("o_totalprice") * 2).cast("long") * 500000
    return read(spark, sf_dir, "orders").select("o_orderkey", sc.micros_to_currency(cost).alias("currency"))


MARKED = "concat(url, CASE WHEN page_id % 3 = 0 THEN '' ELSE concat('?mkt_', CAST(page_id AS STRING)) END)"


@query(
    "x16_after_marker",
    f"SELECT page_id, CASE WHEN strpos(u, 'mkt_') = 0 THEN NULL ELSE string_split(u, 'mkt_')[2] END AS asset FROM (SELECT page_id, {MARKED} AS u FROM pages)",
)
def after_marker(spark, sf_dir):
    return read(spark, sf_dir, "pages").select(
        "page_id", sc.after_marker(F.array(F.expr(MARKED))).alias("asset")
    )


@query(
    "x17_video_url",
    "SELECT p_partkey, CASE WHEN p_size % 4 = 2 THEN concat('https://www.youtube.com/watch?v=', p_brand) ELSE '' END AS url FROM part",
)
def video_url(spark, sf_dir):
    return read(spark, sf_dir, "part").select(
        "p_partkey", sc.video_url(F.col("p_size") % 4, F.col("p_brand")).alias("url")
    )


@query(
    "x18_orientation",
    """SELECT p_partkey, CASE WHEN p_size % 5 = p_partkey % 5 THEN 'Square'
  WHEN p_size % 5 > p_partkey % 5 THEN 'Landscape' ELSE 'Portrait' END AS orientation FROM part""",
)
def orientation(spark, sf_dir):
    return read(spark, sf_dir, "part").select(
        "p_partkey", sc.orientation(F.col("p_size") % 5, F.col("p_partkey") % 5).alias("orientation")
    )


@query(
    "x19_number_ids",
    "SELECT event_id, user_id * 1000000000000000 + 500000000000000 AS id FROM events",
)
def number_ids(spark, sf_dir):
    text = F.concat(F.col("user_id").cast("string"), F.lit(".5E15"))
    return _events(spark, sf_dir).select("event_id", sc.id_from_number_text(text, strict=False).alias("id"))


@query(
    "x20_blank_and_flag",
    f"SELECT event_id, NULLIF({CATEGORY_SQL}, '') AS category, CASE WHEN user_id % 3 > 0 THEN '1' ELSE '0' END AS new_user FROM events",
)
def blank_and_flag(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id", sc.null_if_blank(F.expr(CATEGORY_SQL)).alias("category"),
        sc.flag_from_int(F.col("user_id") % 3).alias("new_user"),
    )


TIMES_SQL = """SELECT user_id, MIN(ts) FILTER (WHERE event_type = 'view') AS b,
  MIN(ts) FILTER (WHERE event_type = 'click') AS i, MIN(ts) FILTER (WHERE event_type = 'purchase') AS c,
  COUNT(*) FILTER (WHERE event_type = 'signup') AS s FROM events GROUP BY user_id"""


@query(
    "x21_funnel_flags",
    f"""SELECT user_id, CASE WHEN b IS NOT NULL THEN '1' END AS bid,
  CASE WHEN b IS NOT NULL AND i IS NOT NULL THEN '1' ELSE '0' END AS imp,
  CASE WHEN b IS NOT NULL AND i IS NOT NULL AND c IS NOT NULL THEN '1' ELSE '0' END AS clk,
  CASE WHEN s > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS cv FROM ({TIMES_SQL})""",
)
def funnel_flags(spark, sf_dir):
    at = lambda kind: F.min(F.when(F.col("event_type") == kind, F.col("ts")))
    users = _events(spark, sf_dir).groupBy("user_id").agg(
        at("view").alias("b"), at("click").alias("i"), at("purchase").alias("c"),
        F.count_if(F.col("event_type") == "signup").alias("s"),
    )
    b, i, c = F.col("b"), F.col("i"), F.col("c")
    return users.select(
        "user_id", sc.bid_flag(b).alias("bid"), sc.imp_flag(b, i).alias("imp"),
        sc.clk_flag(b, i, c).alias("clk"), sc.conversion(F.col("s")).alias("cv"),
    )


@query(
    "x23_stable_id",
    "SELECT event_id, sha256(concat(CAST(user_id AS STRING), '|', event_type)) AS id FROM events",
)
def stable_id(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id", sc.stable_id(F.col("user_id"), F.col("event_type")).alias("id")
    )


@query(
    "f1_where_window",
    "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-19' AND ts < TIMESTAMP '2024-01-20'",
)
def where_window(spark, sf_dir):
    return tw.where_window(_events(spark, sf_dir), "ts", tw.criteria(AS_OF, "1d"))


@query(
    "f2_where_bucket",
    """SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-19' AND hour(ts) = 12
  AND floor(minute(ts) / 30) * 30 = 0""",
)
def where_bucket(spark, sf_dir):
    return tw.where_bucket(_events(spark, sf_dir), "ts", datetime(2024, 1, 19, 12, 0), 30)


@query("f5_in_list", "SELECT * FROM events WHERE event_type IN ('view', 'click')")
def in_list(spark, sf_dir):
    return fl.in_list(_events(spark, sf_dir), "event_type", ["view", "click"])


@query(
    "f6_known_device",
    f"""SELECT event_id, user_id FROM (SELECT event_id, user_id,
  CASE WHEN user_id % 3 = 0 THEN NULL WHEN user_id % 3 = 1 THEN '{fl.ZERO_DEVICE}' ELSE {FULL['DeviceId']} END AS d FROM events)
WHERE d IS NOT NULL AND d <> '{fl.ZERO_DEVICE}'""",
)
def known_device(spark, sf_dir):
    device = F.expr(
        f"CASE WHEN user_id % 3 = 0 THEN NULL WHEN user_id % 3 = 1 THEN '{fl.ZERO_DEVICE}' ELSE {FULL['DeviceId']} END"
    )
    rows = _events(spark, sf_dir).withColumn("d", device)
    return fl.known_device(rows, "d").select("event_id", "user_id")


@query("f7_where_positive", "SELECT * FROM lineitem WHERE l_discount > 0")
def where_positive(spark, sf_dir):
    return fl.where_positive(read(spark, sf_dir, "lineitem"), "l_discount")


FLAGS_SQL = "CAST(event_id % 2 AS STRING) AS imp, CAST(user_id % 2 AS STRING) AS clk"


@query(
    "f8_valid_funnel",
    f"SELECT event_id, imp, clk FROM (SELECT event_id, {FLAGS_SQL} FROM events) WHERE NOT (imp = '0' AND clk = '1')",
)
def valid_funnel(spark, sf_dir):
    rows = _events(spark, sf_dir).selectExpr("event_id", *FLAGS_SQL.split(", "))
    return fl.valid_funnel(rows)


@query(
    "f9_invalid_codes",
    "SELECT event_type, COUNT(*) AS cnt FROM events WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY event_type",
)
def invalid_codes(spark, sf_dir):
    return fl.invalid_codes(_events(spark, sf_dir), "event_type", ["view", "click", "purchase"])


@query(
    "f10_report_filter",
    f"SELECT * FROM ({REPORT_SQL}) WHERE status = 'R' AND networkType IN (2, 3)",
)
def report_filter(spark, sf_dir):
    return fl.report_filter(report(spark, sf_dir), status="R", networkType=[2, 3])


@query("f11_like", "SELECT page_id, url FROM pages WHERE url LIKE '%1%' AND url NOT LIKE '%_2%'")
def like(spark, sf_dir):
    return fl.like(read(spark, sf_dir, "pages"), "url", "%1%", "%_2%").select("page_id", "url")


@query("f12_id_type", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def id_type(spark, sf_dir):
    return fl.id_type(read(spark, sf_dir, "customer"), "c_mktsegment", "BUILDING").select("c_custkey", "c_mktsegment")
