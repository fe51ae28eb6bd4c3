"""Web analytics flattening, nested metrics, and the run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from adflow.operators import eventlog as el
from adflow.operators import web
from adflow.plans.registry import query
from adflow.plans.views import read

K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"
HAS_PARAMS = "event_type <> 'error'"
GA4 = {
    "event_date": "replace(CAST(CAST(ts AS DATE) AS STRING), '-', '')",
    "event_name": "CASE WHEN event_type = 'signup' THEN 'scroll' ELSE event_type END",
    "user_pseudo_id": "concat('p', CAST(user_id AS STRING))",
    "user_id": "CAST(user_id AS STRING)",
    "stream_id": "concat('s', CAST(user_id % 3 AS STRING))",
    "platform": "CASE WHEN user_id % 2 = 0 THEN 'WEB' ELSE 'APP' END",
    "user_first_touch_timestamp": "user_id * 1000",
    "category": "CASE WHEN user_id % 3 = 0 THEN 'mobile' ELSE 'desktop' END",
    "region": "concat('r', CAST(user_id % 9 AS STRING))",
    "city": "concat('c', CAST(user_id % 20 AS STRING))",
    "t_name": "CASE WHEN user_id % 4 = 0 THEN NULL ELSE concat('t', CAST(user_id % 4 AS STRING)) END",
    "t_medium": "'cpc'",
    "t_source": "concat('src', CAST(user_id % 5 AS STRING))",
}
STRING_PARAMS = {
    "prod": "concat('item', CAST(user_id % 6 AS STRING))",
    "page_location": f"concat('/p/', CAST({K} AS STRING))",
    "campaign": "CASE WHEN user_id % 2 = 0 THEN concat('camp', CAST(user_id % 8 AS STRING)) ELSE NULL END",
}
INT_PARAMS = {"ga_session_id": "user_id * 10 + 1", "engagement_time_msec": K, "percent_scrolled": "user_id % 100"}


def _ga4(spark, sf_dir):
    e = {k: F.expr(v) for k, v in GA4.items()}

    def param(key, text=None, number=None):
        return F.struct(F.lit(key).alias("key"), F.struct(
            (F.expr(text) if text else F.lit(None).cast("string")).alias("string_value"),
            (F.expr(number) if number else F.lit(None).cast("long")).alias("int_value"),
        ).alias("value"))

    params = [param(k, text=v) for k, v in STRING_PARAMS.items()]
    params += [param(k, number=v) for k, v in INT_PARAMS.items()]
    params.append(param("ga_session_id", number="user_id"))
    plain = ("event_date", "event_name", "user_pseudo_id", "user_id", "stream_id", "platform", "user_first_touch_timestamp")
    return read(spark, sf_dir, "events").select(
        F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").alias("event_timestamp"),
        *[e[k].alias(k) for k in plain],
        F.struct(e["category"].alias("category")).alias("device"),
        F.struct(e["region"].alias("region"), e["city"].alias("city")).alias("geo"),
        F.struct(e["t_name"].alias("name"), e["t_medium"].alias("medium"), e["t_source"].alias("source")).alias("traffic_source"),
        F.when(F.expr(HAS_PARAMS), F.array(*params)).otherwise(F.array().cast(
            "array<struct<key:string,value:struct<string_value:string,int_value:bigint>>>"
        )).alias("event_params"),
    )


def _ga4_sql(where=""):
    keys = ", ".join(f"{v} AS {k}" for k, v in GA4.items())
    found = {**STRING_PARAMS, **INT_PARAMS}
    params = ", ".join(
        f"{found[p]} AS {p}" if p in found
        else f"CAST(NULL AS {'VARCHAR' if f == 'string_value' else 'BIGINT'}) AS {p}"
        for p, f in web.GA4_PARAMS.items()
    )
    return f"""SELECT * FROM (SELECT DISTINCT epoch_us(ts) AS event_timestamp, ts + INTERVAL 9 HOUR AS event_time, {keys}, {params}
FROM events WHERE {HAS_PARAMS}) {where}"""


@query("w1_ga4_flatten", _ga4_sql())
def ga4_flatten(spark, sf_dir):
    return web.ga4_flatten(_ga4(spark, sf_dir))


@query("w2_ga4_without_scroll", _ga4_sql("WHERE event_name <> 'scroll'"))
def ga4_without_scroll(spark, sf_dir):
    return web.ga4_flatten(_ga4(spark, sf_dir), exclude=("scroll",))


@query("s10_ga4_day_and_intraday", _ga4_sql())
def ga4_day_and_intraday(spark, sf_dir):
    from adflow.session import temp_database
    from adflow.sources import readers as rd
    from adflow.sources import sinks as sk

    database = temp_database(spark, "ga4")
    rows = _ga4(spark, sf_dir)
    sk.overwrite(rows.where("event_date < '20240120'"), f"{database}.daily")
    sk.overwrite(rows.where("event_date >= '20240120'"), f"{database}.intraday")
    return web.ga4_flatten(rd.read_ga4(spark, f"{database}.daily", f"{database}.intraday"))


J17_SQL = " UNION ALL ".join(
    [f"SELECT event_id, '{k}' AS key, {v} AS string_value, CAST(NULL AS BIGINT) AS int_value FROM events WHERE {HAS_PARAMS}" for k, v in STRING_PARAMS.items()]
    + [f"SELECT event_id, '{k}' AS key, NULL AS string_value, {v} AS int_value FROM events WHERE {HAS_PARAMS}" for k, v in INT_PARAMS.items()]
    + [f"SELECT event_id, 'ga_session_id' AS key, NULL AS string_value, user_id AS int_value FROM events WHERE {HAS_PARAMS}"]
)


@query("j17_unnest", f"SELECT key, string_value, int_value, COUNT(*) AS cnt FROM ({J17_SQL}) GROUP BY ALL")
def unnest(spark, sf_dir):
    rows = web.unnest(_ga4(spark, sf_dir), "event_params", ["event_timestamp"])
    return rows.groupBy("key", "value.string_value", "value.int_value").agg(F.count("*").alias("cnt"))


KV_PIVOT_SQL = """SELECT user_id, MAX(CASE WHEN event_type = 'view' THEN value END) AS view,
  MAX(CASE WHEN event_type = 'click' THEN value END) AS click FROM events GROUP BY user_id"""


@query("a20_conditional_max", KV_PIVOT_SQL)
def conditional_max(spark, sf_dir):
    at = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("value"))).alias(kind)
    return read(spark, sf_dir, "events").groupBy("user_id").agg(at("view"), at("click"))


ACTIONS = """CASE WHEN event_type = 'error' THEN NULL ELSE array(
  named_struct('action_type', 'link_click', 'value', CAST(user_id AS STRING)),
  named_struct('action_type', CASE WHEN event_type = 'view' THEN 'link_click' ELSE 'video_view' END, 'value', CAST(event_id AS STRING))) END"""


@query(
    "w3_pivot_actions",
    """SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN CAST(event_id AS STRING) ELSE CAST(user_id AS STRING) END AS "linkClick",
  CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE CAST(event_id AS STRING) END AS "videoView",
  CAST(NULL AS VARCHAR) AS "appInstall",
  CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN CAST(event_id AS STRING) ELSE CAST(user_id AS STRING) END AS "uniqueLinkClick" FROM events""",
)
def pivot_actions(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("event_id", F.expr(ACTIONS).alias("actions"))
    columns = {
        **web.pivot_actions("actions", ["link_click", "video_view", "app_install"]),
        **web.pivot_actions("actions", ["link_click"], "unique_"),
    }
    return rows.select("event_id", *[c.alias(n) for n, c in columns.items()])


@query(
    "w4_first_value",
    "SELECT event_id, CASE event_type WHEN 'error' THEN NULL ELSE CAST(user_id AS STRING) END AS first FROM events",
)
def first_value(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("event_id", F.expr(ACTIONS).alias("actions"))
    return rows.select("event_id", web.first_value("actions").alias("first"))


@query(
    "w5_default_metrics",
    "SELECT event_id, CASE event_type WHEN 'error' THEN '0' WHEN 'view' THEN '0' ELSE CAST(user_id AS STRING) END AS reach, '0' AS spend FROM events",
)
def default_metrics(spark, sf_dir):
    rows = read(spark, sf_dir, "events").selectExpr(
        "event_id", "CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN '' ELSE CAST(user_id AS STRING) END AS reach"
    )
    return web.default_metrics(rows, ["reach", "spend"])


DAILY = {
    "impressions": ["l_quantity", "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_extendedprice END", "l_tax"],
    "engagements": ["CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_discount END", "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_tax END", "NULL"],
}
DAILY_SQL = " UNION ALL ".join(
    f"SELECT l_orderkey, l_partkey, CAST(DATE '2024-01-31' + {d} AS VARCHAR) AS \"segmentDate\", "
    + ", ".join(f"CAST({DAILY[m][d]} AS DOUBLE) AS {m}" for m in DAILY)
    + " FROM lineitem"
    for d in range(3)
)


@query(
    "w6_explode_daily",
    f"""SELECT l_orderkey, l_partkey, strftime(CAST("segmentDate" AS TIMESTAMP), '%Y-%m-%d') AS "segmentDate",
  COALESCE(impressions, 0) AS impressions, COALESCE(engagements, 0) AS engagements
FROM ({DAILY_SQL}) WHERE impressions IS NOT NULL OR engagements IS NOT NULL""",
)
def explode_daily(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey",
        *[F.array(*[F.expr(v).cast("double") for v in values]).alias(m) for m, values in DAILY.items()],
    )
    out = web.explode_daily(rows, ["l_orderkey", "l_partkey"], {m: m for m in DAILY}, "2024-01-31")
    return out.withColumn("segmentDate", F.col("segmentDate").cast("string"))


DETAIL = (
    "CASE event_type"
    f" WHEN 'click' THEN concat('{{\"user_action\":{{\"action\":\"', CASE WHEN user_id % 2 = 0 THEN 'START' ELSE 'STOP' END, '\",\"user_name\":\"u', CAST(user_id AS STRING), '\"}}}}')"
    f" WHEN 'signup' THEN concat('{{\"flow_definition\":{{\"output_dataset\":\"o', CAST(user_id % 7 AS STRING), '\",\"input_datasets\":[\"i', CAST(user_id % 5 AS STRING), '\",\"raw\"]}}}}')"
    f" WHEN 'purchase' THEN '{{\"create_update\":{{}}}}'"
    f" ELSE concat('{{\"flow_progress\":{{\"data_quality\":[{{\"dropped_records\":', CAST({K} AS STRING), '}},{{\"dropped_records\":', CAST(user_id % 4 AS STRING), '}}]}}}}') END"
)
MESSAGE = "concat('Completed a streaming update of ', ' table_', CAST(user_id % 12 AS STRING), CASE WHEN user_id % 6 = 5 THEN '_v2' ELSE '' END, ' and nothing else here')"
LOG = {
    "id": "event_id",
    "timestamp": "ts",
    "message": MESSAGE,
    "level": "CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END",
    "error": "CASE WHEN event_type = 'error' THEN concat('trace ', CAST(event_id AS STRING)) ELSE NULL END",
    "details": DETAIL,
    "event_type": "CASE event_type WHEN 'click' THEN 'user_action' WHEN 'signup' THEN 'flow_definition' WHEN 'purchase' THEN 'create_update' ELSE 'flow_progress' END",
}
UPDATE_ID = "concat('run', CAST(user_id AS STRING))"
LOG_SQL = "SELECT " + ", ".join(f'{v} AS "{k}"' for k, v in LOG.items()) + f", {UPDATE_ID} AS update_id, {K} AS k, user_id FROM events"


def _log(spark, sf_dir):
    return read(spark, sf_dir, "events").select(
        *[F.expr(v).alias(k) for k, v in LOG.items()],
        F.struct(F.expr(UPDATE_ID).alias("update_id")).alias("origin"),
    )


@query("l1_failed_events", f"SELECT id, \"timestamp\", message, level, error FROM ({LOG_SQL}) WHERE event_type = 'flow_progress' AND error IS NOT NULL")
def failed_events(spark, sf_dir):
    return el.failed_events(_log(spark, sf_dir)).select("id", "timestamp", "message", "level", "error")


@query(
    "l2_audit",
    "SELECT ts AS \"timestamp\", CASE WHEN user_id % 2 = 0 THEN 'START' ELSE 'STOP' END AS action, concat('u', CAST(user_id AS STRING)) AS user_name FROM events WHERE event_type = 'click'",
)
def audit(spark, sf_dir):
    return el.audit(_log(spark, sf_dir))


DROPPED_SQL = f"""SELECT 'table_' || CAST(user_id % 12 AS VARCHAR) AS table_name, message, CAST(SUM(k + user_id % 4) AS BIGINT) AS dropped_records
FROM ({LOG_SQL}) WHERE event_type = 'flow_progress' AND message NOT LIKE '%_v2%' GROUP BY table_name, message"""


@query("l3_dropped_records", DROPPED_SQL)
def dropped_records(spark, sf_dir):
    return el.dropped_records(_log(spark, sf_dir))


@query("l3_alerts", f"SELECT * FROM ({DROPPED_SQL}) WHERE dropped_records > 0")
def alerts(spark, sf_dir):
    return el.alerts(_log(spark, sf_dir))


@query("l4_latest_update", f"SELECT {UPDATE_ID} AS update_id FROM events WHERE event_type = 'purchase' ORDER BY ts DESC, event_id DESC LIMIT 1")
def latest_update(spark, sf_dir):
    return el.latest_update(_log(spark, sf_dir))


@query(
    "l5_lineage",
    f"""SELECT {UPDATE_ID} AS update_id, unnest([concat('i', CAST(user_id % 5 AS STRING)), 'raw']) AS input_dataset,
  concat('o', CAST(user_id % 7 AS STRING)) AS output_dataset FROM events WHERE event_type = 'signup'""",
)
def lineage(spark, sf_dir):
    return el.lineage(_log(spark, sf_dir))


@query("w7_expand_json", f"SELECT event_id, CAST({K} AS BIGINT) AS k FROM events")
def expand_json(spark, sf_dir):
    wrapped = read(spark, sf_dir, "events").withColumn("doc", F.concat(F.lit('{"rows":['), "props", F.lit("]}")))
    rows = web.expand_json(wrapped, "doc", "$.rows", "array<struct<k: bigint>>", "row")
    return rows.select("event_id", "row.k")
