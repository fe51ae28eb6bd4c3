"""Sources, sinks, and table jobs, fed from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from adflow.plans.registry import query
from adflow.plans.views import REPORT_SQL, read, report
from adflow.session import temp_database, work_dir
from adflow.sources import catalog as ct
from adflow.sources import readers as rd
from adflow.sources import sinks as sk

EVENTS = "SELECT * FROM events"


def _events(spark, sf_dir):
    return read(spark, sf_dir, "events")


def _landed_json(spark, sf_dir, codec="gzip"):
    path = work_dir(spark, "landed")
    _events(spark, sf_dir).write.options(**rd.MICROS).json(path, compression=codec)
    return path


@query("s3_read_json", EVENTS)
def read_json(spark, sf_dir):
    events = _events(spark, sf_dir)
    return rd.read_json(spark, _landed_json(spark, sf_dir), events.schema)


@query("s3_read_json_inferred", "SELECT event_id, user_id, event_type, value, props FROM events")
def read_json_inferred(spark, sf_dir):
    return rd.read_json(spark, _landed_json(spark, sf_dir)).select("event_id", "user_id", "event_type", "value", "props")


@query(
    "s4_read_partitions",
    """SELECT event_id, user_id, CAST(day(ts) AS INT) AS day, CAST(hour(ts) AS INT) AS hour FROM events
WHERE year(ts) = 2024 AND month(ts) = 1 AND hour(ts) BETWEEN 10 AND 19""",
)
def read_partitions(spark, sf_dir):
    base = work_dir(spark, "hive")
    parts = ["year", "month", "day", "hour"]
    rows = _events(spark, sf_dir).selectExpr(
        "event_id", "user_id", "year(ts) AS year", "month(ts) AS month", "day(ts) AS day", "hour(ts) AS hour"
    )
    sk.write_partitioned(rows, base, parts)
    return rd.read_partitions(spark, base, "2024", "1", hour="1?").select("event_id", "user_id", "day", "hour")


@query("s5_read_csv", "SELECT c_custkey AS \"CustKey\", c_name AS \"CustName\", c_acctbal AS \"Balance\" FROM customer")
def read_csv(spark, sf_dir):
    path = work_dir(spark, "csv")
    read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Cust Key"), F.col("c_name").alias("Cust Name"), F.col("c_acctbal").alias("Balance")
    ).write.option("header", True).csv(path)
    schema = T.StructType.fromDDL("`Cust Key` bigint, `Cust Name` string, Balance double")
    return rd.read_csv(spark, path, schema)


@query(
    "s6_clean_dimension",
    "SELECT c_custkey, c_name AS \"Name\", CAST(c_nationkey % 2 AS INT) AS \"DelYN\", strftime(TIMESTAMP '2024-01-01' + to_seconds(c_custkey % 86400), '%H:%M:%S') AS \"StartTime\" FROM customer",
)
def clean_dimension(spark, sf_dir):
    raw = read(spark, sf_dir, "customer").select(
        "c_custkey", F.base64(F.col("c_name").cast("binary")).alias("Name"),
        (F.col("c_nationkey") % 2 == 1).alias("DelYN"),
        F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, c_custkey % 86400)").alias("StartTime"),
    )
    return rd.clean_dimension(raw)


@query("s8_read_window", "SELECT event_id, CAST(CAST(ts AS DATE) AS STRING) AS event_date FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-08'")
def read_window(spark, sf_dir):
    table = f"{temp_database(spark, 'window')}.events"
    sk.overwrite(_events(spark, sf_dir).select("event_id", F.to_date("ts").alias("event_date")), table, ["event_date"])
    rows = rd.read_window(spark, table, "event_date", "2024-01-05", "2024-01-07")
    return rows.withColumn("event_date", F.col("event_date").cast("string"))


@query("s9_read_report", f"SELECT campaignId, adId, segmentsDate, impressions, costMicros FROM ({REPORT_SQL})")
def read_report(spark, sf_dir):
    path = work_dir(spark, "report")
    rows = report(spark, sf_dir).select("campaignId", "adId", "segmentsDate", "impressions", "costMicros", "status")
    rows.write.json(path)
    schema = rows.drop("status").schema
    return rd.read_report(spark, path, schema)


@query(
    "s11_load_query",
    "SELECT event_type, COUNT(*) AS events, COUNT(DISTINCT user_id) AS users FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-20' GROUP BY event_type",
)
def load_query(spark, sf_dir):
    _events(spark, sf_dir).createOrReplaceTempView("events_view")
    return rd.load_query(spark, "daily_spend", start="2024-01-03 00:00:00", end="2024-01-20 00:00:00")


@query("s12_drop_all_null", "SELECT CASE WHEN event_type = 'view' THEN event_id END AS id, CASE WHEN event_type = 'view' THEN value END AS v FROM events WHERE event_type = 'view'")
def drop_all_null(spark, sf_dir):
    sheet = _events(spark, sf_dir).selectExpr(
        "CASE WHEN event_type = 'view' THEN event_id END AS id", "CAST(NULL AS string) AS blank",
        "CASE WHEN event_type = 'view' THEN value END AS v",
    )
    return rd.drop_all_null(sheet)


# --- sinks -----------------------------------------------------------------

FACT = ["adId", "campaignId", "segmentsDate", "impressions", "status", "segmentsMonth"]
FACT_SQL = f"SELECT adId, campaignId, segmentsDate, impressions, status, substring(segmentsDate, 1, 4) AS segmentsMonth FROM ({REPORT_SQL})"


def _fact(spark, sf_dir):
    return report(spark, sf_dir).withColumn("segmentsMonth", F.substring("segmentsDate", 1, 4)).select(*FACT)


def _fact_table(spark, sf_dir, label):
    table = f"{temp_database(spark, label)}.fact"
    sk.overwrite(_fact(spark, sf_dir), table, ["segmentsMonth"])
    return table


@query("k1_append", f"SELECT * FROM ({FACT_SQL}) UNION ALL SELECT * FROM ({FACT_SQL}) WHERE status = 'R'")
def append(spark, sf_dir):
    table = _fact_table(spark, sf_dir, "append")
    sk.append(_fact(spark, sf_dir).where("status = 'R'"), table, ["segmentsMonth"])
    return spark.table(table).select(*FACT)


START, END = "1997-03-10", "1998-05-02"
NEW_SQL = f"SELECT adId, campaignId, segmentsDate, impressions + 1 AS impressions, status, segmentsMonth FROM ({FACT_SQL}) WHERE segmentsDate >= '{START}' AND segmentsDate < '{END}' AND status <> 'A'"


def _in_window(start=START, end=END):
    return (F.col("segmentsDate") >= start) & (F.col("segmentsDate") < end)


def _new(spark, sf_dir, start=START, end=END):
    rows = _fact(spark, sf_dir).where(_in_window(start, end)).where("status <> 'A'")
    return rows.withColumn("impressions", F.col("impressions") + 1)


@query("k2_replace_window", f"SELECT * FROM ({FACT_SQL}) WHERE NOT (segmentsDate >= '{START}' AND segmentsDate < '{END}') UNION ALL {NEW_SQL}")
def replace_window(spark, sf_dir):
    table = _fact_table(spark, sf_dir, "replace")
    sk.replace_window(_new(spark, sf_dir), table, _in_window())
    return spark.table(table).select(*FACT)


@query(
    "k3_replace_scoped",
    f"SELECT * FROM ({FACT_SQL}) WHERE NOT (segmentsDate >= '{START}' AND segmentsDate < '{END}' AND status = 'R') UNION ALL SELECT * FROM ({NEW_SQL}) WHERE status = 'R'",
)
def replace_scoped(spark, sf_dir):
    table = _fact_table(spark, sf_dir, "scoped")
    sk.replace_window(_new(spark, sf_dir).where("status = 'R'"), table, _in_window(), scope={"status": "R"})
    return spark.table(table).select(*FACT)


@query("k2_replace_emptied", f"SELECT * FROM ({FACT_SQL}) WHERE NOT (segmentsDate >= '1997-01-01' AND segmentsDate < '1999-01-01')")
def replace_emptied(spark, sf_dir):
    table = _fact_table(spark, sf_dir, "emptied")
    sk.replace_window(_fact(spark, sf_dir).where("false"), table, _in_window("1997-01-01", "1999-01-01"))
    return spark.table(table).select(*FACT)


@query("k4_refresh_dimension", "SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey > 3")
def refresh_dimension(spark, sf_dir):
    table = f"{temp_database(spark, 'dim')}.supplier"
    rows = read(spark, sf_dir, "supplier")
    sk.refresh_dim(rows.select("s_suppkey", "s_name"), table)
    sk.refresh_dim(rows.where("s_nationkey > 3").select("s_suppkey", "s_name"), table)
    return spark.table(table)


@query("k5_overwrite", "SELECT * FROM part")
def overwrite(spark, sf_dir):
    table = f"{temp_database(spark, 'over')}.part"
    sk.overwrite(read(spark, sf_dir, "part"), table)
    return spark.table(table)


@query("k6_export_parquet", "SELECT * FROM events")
def export_parquet(spark, sf_dir):
    base = work_dir(spark, "export")
    return spark.read.parquet(sk.export_parquet(_events(spark, sf_dir), base, "2024-01-20", "07"))


@query("k7_partitioned_sink", "SELECT event_id, event_type, CAST(CAST(ts AS DATE) AS STRING) AS actiontime_date, CAST(hour(ts) AS INT) AS actiontime_hour FROM events")
def partitioned_sink(spark, sf_dir):
    path = work_dir(spark, "parts")
    rows = _events(spark, sf_dir).select(
        "event_id", "event_type", F.to_date("ts").alias("actiontime_date"), F.hour("ts").alias("actiontime_hour")
    )
    sk.write_partitioned(rows, path, ["actiontime_date", "actiontime_hour"])
    return spark.read.parquet(path).withColumn("actiontime_date", F.col("actiontime_date").cast("string"))


# --- table jobs ------------------------------------------------------------

def _small_db(spark, sf_dir, label, names):
    database = temp_database(spark, label)
    for name in names:
        sk.overwrite(read(spark, sf_dir, name.removeprefix("tt_")), f"{database}.{name}")
    return database


@query(
    "q1_find_tables",
    "SELECT 'orders' AS \"table\", COUNT(*) AS \"rows\" FROM orders UNION ALL SELECT 'customer', COUNT(*) FROM customer",
)
def find_tables(spark, sf_dir):
    database = _small_db(spark, sf_dir, "find", ["orders", "customer", "tt_orders", "part"])
    names = ct.find_tables(spark, database, "contains", ["order", "cust"])
    return ct.table_inventory(spark, database, names)


@query(
    "r1_list_tables",
    "SELECT 'orders' AS \"table\", COUNT(*) AS \"rows\" FROM orders UNION ALL SELECT 'part', COUNT(*) FROM part",
)
def list_tables(spark, sf_dir):
    database = _small_db(spark, sf_dir, "list", ["orders", "part"])
    spark.sql(f"CREATE VIEW {database}.recent AS SELECT o_orderkey FROM {database}.orders")
    return ct.table_inventory(spark, database, [t for _, t in ct.list_tables(spark, [database])])


@query(
    "r2_clone_tables",
    "SELECT 'events' AS \"table\", COUNT(*) AS \"rows\" FROM events UNION ALL SELECT 'part', COUNT(*) FROM part",
)
def clone_tables(spark, sf_dir):
    source = _small_db(spark, sf_dir, "prod", ["part"])
    sk.overwrite(_events(spark, sf_dir).withColumn("event_date", F.to_date("ts")), f"{source}.events", ["event_date"])
    return ct.clone_tables(spark, source, temp_database(spark, "dev"), ["events", "part"])


@query("r3_sync_dev", "SELECT 'orders' AS \"table\", COUNT(*) AS \"rows\" FROM orders")
def sync_dev(spark, sf_dir):
    source = _small_db(spark, sf_dir, "prod", ["orders", "part"])
    dev = _small_db(spark, sf_dir, "dev", ["part"])
    stale = read(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
    sk.overwrite(stale, f"{dev}.orders")
    return ct.sync_dev(spark, source, dev)


@query("r4_partition_tables", "SELECT event_id, event_type, CAST(CAST(ts AS DATE) AS STRING) AS event_date FROM events")
def partition_tables(spark, sf_dir):
    database = temp_database(spark, "layout")
    sk.overwrite(_events(spark, sf_dir).select("event_id", "event_type", F.to_date("ts").alias("event_date")), f"{database}.events")
    ct.partition_tables(spark, database, ["events"], row_threshold=10)
    return spark.table(f"{database}.events").withColumn("event_date", F.col("event_date").cast("string"))


def _nested(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", F.struct(
        F.struct(F.col("value").alias("price"), F.col("user_id").alias("uid")).alias("device"),
        F.col("event_type").alias("kind"),
    ).alias("request"))


@query("r5_alter_nested", "SELECT event_id, CAST(user_id AS VARCHAR) AS uid, value AS price, event_type AS kind FROM events")
def alter_nested(spark, sf_dir):
    changed = ct.alter_nested(_nested(spark, sf_dir), "request.device.uid", "string")
    return changed.select("event_id", "request.device.uid", "request.device.price", "request.kind")


@query("w8_cast_nested", "SELECT event_id, CAST(value AS VARCHAR) AS price, user_id AS uid FROM events")
def cast_nested(spark, sf_dir):
    changed = ct.alter_nested(_nested(spark, sf_dir), "request.device.price", "string")
    return changed.select("event_id", "request.device.price", "request.device.uid")


@query("w9_cast_in_array", "SELECT event_id, CAST(user_id AS VARCHAR) AS first_uid, CAST(event_id AS VARCHAR) AS second_uid FROM events")
def cast_in_array(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", F.array(
        F.struct(F.col("user_id").alias("uid"), F.lit("a").alias("tag")),
        F.struct(F.col("event_id").alias("uid"), F.lit("b").alias("tag")),
    ).alias("items"))
    items = ct.cast_in_array(rows, "items", "uid", "string")
    return items.select("event_id", F.get("items", F.lit(0))["uid"].alias("first_uid"), F.get("items", F.lit(1))["uid"].alias("second_uid"))


@query("r6_alter_column", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders")
def alter_column(spark, sf_dir):
    database = temp_database(spark, "alter")
    sk.overwrite(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), f"{database}.orders")
    ct.alter_column(spark, f"{database}.orders", "o_custkey", "string")
    return spark.table(f"{database}.orders")


@query("r7_read_merged", "SELECT event_id, user_id, CASE WHEN event_type = 'view' THEN value END AS value FROM events")
def read_merged(spark, sf_dir):
    base = work_dir(spark, "merged")
    events = _events(spark, sf_dir)
    events.where("event_type = 'view'").select("event_id", "user_id", "value").write.parquet(f"{base}/new")
    events.where("event_type <> 'view'").select("event_id", "user_id").write.parquet(f"{base}/old")
    return ct.read_merged(spark, f"{base}/old", f"{base}/new").select("event_id", "user_id", "value")


@query("r8_frozen_schema", EVENTS)
def frozen_schema(spark, sf_dir):
    path = work_dir(spark, "schema")
    rd.freeze_schema(_events(spark, sf_dir), path)
    return rd.read_json(spark, _landed_json(spark, sf_dir), rd.load_schema(spark, path))


@query("r9_create_like", "SELECT * FROM supplier")
def create_like(spark, sf_dir):
    database = _small_db(spark, sf_dir, "like", ["supplier"])
    ct.create_like(spark, f"{database}.supplier", f"{database}.copy")
    sk.append(spark.table(f"{database}.supplier"), f"{database}.copy")
    return spark.table(f"{database}.copy")


@query("r10_partition_values", "SELECT event_type, COUNT(*) AS \"rows\" FROM events GROUP BY event_type")
def partition_values(spark, sf_dir):
    spread = ct.partition_values(_events(spark, sf_dir).hint("rebalance"), "event_type")
    return spread.groupBy("event_type").agg(F.sum("rows").alias("rows"))


@query("r10_partition_profile", "SELECT CAST(event_id % 7 AS INT) AS partition, COUNT(*) AS \"rows\" FROM events GROUP BY ALL")
def partition_profile(spark, sf_dir):
    """Events dealt to seven partitions by number."""
    dealt = _events(spark, sf_dir).repartitionById(7, F.expr("CAST(event_id % 7 AS INT)"))
    return ct.partition_profile(dealt)


@query(
    "q12_schema_diff",
    """SELECT * FROM (VALUES ('customer', '*', NULL, 'present'), ('nation', '*', 'present', NULL), ('orders', 'o_totalprice', 'double', 'string'),
  ('orders', 'o_comment', NULL, 'string'), ('part', 'p_size', 'int', NULL)) AS t("table", "column", "left", "right") WHERE (SELECT COUNT(*) FROM orders) > 0""",
)
def schema_diff(spark, sf_dir):
    """Two databases out of the given tables: a type, a column more, one less, one-sided tables."""
    left = _small_db(spark, sf_dir, "left", ["orders", "part", "nation"])
    right = _small_db(spark, sf_dir, "right", ["customer"])
    orders = read(spark, sf_dir, "orders")
    sk.overwrite(orders.withColumn("o_totalprice", F.col("o_totalprice").cast("string")).withColumn("o_comment", F.lit("x")), f"{right}.orders")
    sk.overwrite(read(spark, sf_dir, "part").drop("p_size"), f"{right}.part")
    return ct.schema_diff(spark, left, right)


@query("r11_write_sized", "SELECT * FROM lineitem")
def write_sized(spark, sf_dir):
    path = work_dir(spark, "sized")
    sk.write_sized(read(spark, sf_dir, "lineitem"), path, 2_000_000)
    return spark.read.parquet(path)
