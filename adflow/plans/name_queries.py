"""Renaming, flattening and reshaping of column sets."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from adflow.functions import names as nm
from adflow.functions import recode as rc
from adflow.plans.registry import query
from adflow.plans.views import REPORT_SQL, read, report


@query("p7_snake_to_camel", "SELECT c_custkey AS \"cCustkey\", c_name AS \"cName\", c_nationkey AS \"cNationkey\", c_acctbal AS \"cAcctbal\", c_mktsegment AS \"cMktsegment\" FROM customer")
def snake_to_camel(spark, sf_dir):
    return nm.snake_to_camel(read(spark, sf_dir, "customer"))


@query(
    "p8_camel_to_snake",
    f"SELECT campaignId AS campaign_id, adgroupName AS adgroup_name, costMicros AS cost_micros, rowNo AS row_no, adId AS ad_id FROM ({REPORT_SQL})",
)
def camel_to_snake(spark, sf_dir):
    return nm.camel_to_snake(report(spark, sf_dir).select("campaignId", "adgroupName", "costMicros", "rowNo", "adId"))


@query(
    "p9_normalize_names",
    "SELECT s_suppkey AS \"creativeId\", s_acctbal AS \"metricsCostSum\", s_nationkey AS \"metricsVideoPlay\" FROM supplier",
)
def normalize_names(spark, sf_dir):
    return nm.normalize_names(read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("dimensions.creative_id"), F.col("s_acctbal").alias("metrics.cost_sum"),
        F.col("s_nationkey").alias("metrics.video_play"),
    ))


# Headers of the code table file.
CODE_HEADERS = {"카테고리 코드": "category_code", "속성 코드": "attribution_code", "카테고리": "category", "속성 이름": "attribution"}


@query(
    "p10_rename_map",
    "SELECT p_brand AS category_code, p_partkey AS attribution_code, p_type AS category, p_name AS attribution FROM part",
)
def rename_map(spark, sf_dir):
    korean = read(spark, sf_dir, "part").select(
        F.col("p_brand").alias("카테고리 코드"), F.col("p_partkey").alias("속성 코드"),
        F.col("p_type").alias("카테고리"), F.col("p_name").alias("속성 이름"),
    )
    return nm.rename_map(korean, CODE_HEADERS)


@query("p11_strip_names", "SELECT n_nationkey AS \"NationKey\", n_name AS \"NationName\" FROM nation")
def strip_names(spark, sf_dir):
    return nm.strip_names(read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("Nation Key"), F.col("n_name").alias("Nation Name")
    ))


@query(
    "p12_normalize_records",
    """SELECT l_orderkey AS order_id, l_linestatus AS status, p AS part, CASE p WHEN 0 THEN l_quantity ELSE l_extendedprice END AS metrics_amount,
  CASE p WHEN 0 THEN l_tax ELSE l_discount END AS metrics_detail_rate FROM lineitem, (VALUES (0), (1)) AS t(p)""",
)
def normalize_records(spark, sf_dir):
    def record(part, amount, rate):
        detail = F.struct(F.col(rate).alias("rate"))
        metrics = F.struct(F.col(amount).alias("amount"), detail.alias("detail"))
        return F.struct(F.lit(part).alias("part"), metrics.alias("metrics"))

    nested = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linestatus").alias("status"),
        F.array(record(0, "l_quantity", "l_tax"), record(1, "l_extendedprice", "l_discount")).alias("data"),
    )
    return nm.normalize(nested, "data", ["order_id", "status"])


@query(
    "p13_propagate",
    "SELECT s_nationkey AS \"campaignId\", s_suppkey AS \"adId\", n_name AS \"campaignName\", n_regionkey AS \"accountId\" FROM supplier JOIN nation ON s_nationkey = n_nationkey",
)
def propagate(spark, sf_dir):
    ads = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("campaignId"), F.col("s_suppkey").alias("adId"))
    parent = read(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "campaignId")
    return nm.propagate(ads, parent, "campaignId", {"n_name": "campaignName", "n_regionkey": "accountId"})


@query("p14_drop_cols", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def drop_cols(spark, sf_dir):
    return nm.drop_cols(read(spark, sf_dir, "customer"), ["c_acctbal", "c_nationkey", "not_there"])


@query("p15_stamp", "SELECT *, '2024-01-20' AS \"washDate\", 'main account' AS \"customerName\" FROM supplier")
def stamp(spark, sf_dir):
    return nm.stamp(read(spark, sf_dir, "supplier"), washDate="2024-01-20", customerName="main account")


@query("p16_select_regex", "SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders")
def select_regex(spark, sf_dir):
    return nm.select_regex(read(spark, sf_dir, "orders"), "o_order.*")


@query("p17_add_null_cols", "SELECT *, CAST(NULL AS DOUBLE) AS budget, CAST(NULL AS VARCHAR) AS note FROM nation")
def add_null_cols(spark, sf_dir):
    wanted = T.StructType([
        T.StructField("n_name", T.StringType()), T.StructField("budget", T.DoubleType()), T.StructField("note", T.StringType()),
    ])
    return nm.add_null_cols(read(spark, sf_dir, "nation"), wanted)


@query(
    "k8_conform",
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(NULL AS INTEGER) AS budget FROM customer",
)
def conform(spark, sf_dir):
    target = T.StructType([
        T.StructField("c_custkey", T.StringType()), T.StructField("c_name", T.StringType()), T.StructField("budget", T.IntegerType()),
    ])
    return nm.conform(read(spark, sf_dir, "customer"), target)


@query(
    "k9_fill_metrics",
    "SELECT o_orderkey, COALESCE(l.n, 0) AS n FROM orders LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) l ON o_orderkey = l.l_orderkey",
)
def fill_metrics(spark, sf_dir):
    counts = read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(
        F.col("l_orderkey").alias("o_orderkey")
    ).agg(F.count("*").alias("n"))
    return nm.fill_metrics(read(spark, sf_dir, "orders").select("o_orderkey").join(counts, "o_orderkey", "left"), ["n"])


@query("k10_presave_dedup", f"SELECT DISTINCT campaignId, adgroupId, networkType, deviceCode FROM ({REPORT_SQL})")
def presave_dedup(spark, sf_dir):
    return report(spark, sf_dir).select("campaignId", "adgroupId", "networkType", "deviceCode").distinct()


@query(
    "a19_decode_codes",
    """WITH x AS (SELECT c_custkey, unnest([c_nationkey, (c_nationkey + 7) % 40, c_nationkey + 30]) AS code FROM customer)
SELECT c_custkey, COALESCE(string_agg(n_name, ',' ORDER BY n_name), '') AS names FROM x LEFT JOIN nation ON code = n_nationkey GROUP BY c_custkey""",
)
def decode_codes(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select(
        "c_custkey", F.expr("array(c_nationkey, (c_nationkey + 7) % 40, c_nationkey + 30)").alias("codes")
    )
    codes = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"))
    named = rc.decode_codes(rows, ["c_custkey"], "codes", codes, "labels")
    return named.select("c_custkey", F.array_join("labels", ",").alias("names"))
