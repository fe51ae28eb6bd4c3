"""Bid request splits and counts, rules, price profiles and top lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from adflow.operators import bidreq as br
from adflow.operators import rollup as ru
from adflow.operators import useragent as uag
from adflow.plans.registry import query
from adflow.plans.views import (
    AGENT_FIELDS,
    FULL,
    HEAD,
    PRICE,
    REQUEST,
    agent_case,
    bronze,
    flat_sql,
    read,
    sql_cols,
)

TIMES = {**HEAD, "actiontime_date": "CAST(CAST(ts AS DATE) AS STRING)"}
KEYS = {k: FULL[k] for k in br.KEYS}
DEVICE_ID = {"device_id": FULL["DeviceId"]}
MONEY = {
    "bid_price": f"CAST({REQUEST['bid_price']} AS DOUBLE)",
    "bidfloor": REQUEST["bidfloor"],
}


def _flat(spark, sf_dir):
    return br.flatten_request(bronze(spark, sf_dir, "bid"))


def _plain(df):
    """Day as text and prices as doubles, so that both engines print them alike."""
    for name in ("actiontime_date",):
        if name in df.columns:
            df = df.withColumn(name, F.col(name).cast("string"))
    if "bid_price" in df.columns:
        df = df.withColumn("bid_price", F.col("bid_price").cast("double"))
    return df


SPLIT_SQL = {
    "bundle": {
        "bundle": REQUEST["bundle"], "bid_price": MONEY["bid_price"],
        "bid_floor": REQUEST["bidfloor"], **DEVICE_ID,
    },
    "banner": {"banner_w": FULL["Width"], "banner_h": FULL["Height"], **DEVICE_ID},
    "geo": {k: REQUEST[k] for k in ("country", "region", "lat", "lon", "ip")},
}


# What each agent of the fixture has to be read as is written out with the agents, by hand.
UA_COLS = {name: agent_case(name) for name in AGENT_FIELDS}
UA_SQL = flat_sql("bid", UA_COLS | {k: REQUEST[k] for k in ("os", "osv", "make", "model")} | KEYS | TIMES)

FLAT_LEAVES = {
    "bidfloor": MONEY["bidfloor"], "bid_price": MONEY["bid_price"],
    "bundle": REQUEST["bundle"], "tagid": REQUEST["tagid"], "banner_h": FULL["Height"],
    **{k: REQUEST[k] for k in ("ua", "devicetype", "ip", "region")},
    **DEVICE_ID, **KEYS, **TIMES,
}


@query("p1_flatten_request", flat_sql("bid", FLAT_LEAVES))
def flatten_request(spark, sf_dir):
    first = F.get("imp", F.lit(0))
    return _plain(_flat(spark, sf_dir)).select(
        "bidfloor", "bid_price", "app.bundle", first["tagid"].alias("tagid"),
        first["banner"]["h"].alias("banner_h"), "device.ua", "device.devicetype",
        "device.ip", "device.geo.region", "device_id", *br.KEYS, *br.TIMES,
    )


for _id, _split in (("p2", "bundle"), ("p3", "banner"), ("p4", "geo")):

    @query(f"{_id}_split_{_split}", flat_sql("bid", {**SPLIT_SQL[_split], **KEYS, **TIMES}))
    def split_rows(spark, sf_dir, split=_split):
        return _plain(br.SPLITS[split](_flat(spark, sf_dir)))


@query("p5_split_ua", UA_SQL)
def split_ua(spark, sf_dir):
    return _plain(br.split_ua(_flat(spark, sf_dir)))


U1_SQL = f"SELECT event_id, {sql_cols(UA_COLS)} FROM events"


@query("u1_enrich_ua", U1_SQL)
def enrich_ua(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_id", F.expr(REQUEST["ua"]).alias("ua"))
    return uag.enrich_ua(events, F.col("ua"), "p").select("event_id", "p.*")


def _count_sql(split):
    inner = UA_SQL if split == "ua" else flat_sql("bid", {**SPLIT_SQL[split], **KEYS, **TIMES})
    keys = ", ".join([*br.SPLIT_KEYS[split], *br.COUNT_KEYS])
    return f"""WITH s AS ({inner}),
f AS (SELECT *, row_number() OVER (PARTITION BY tid ORDER BY actiontime_local, {keys}) AS rn FROM s)
SELECT {keys}, COUNT(*) AS "count" FROM f WHERE rn = 1 GROUP BY ALL"""


for _id, _split in (("a5", "bundle"), ("a6", "banner"), ("a7", "geo"), ("a8", "ua")):

    @query(f"{_id}_count_{_split}", _count_sql(_split))
    def count_split(spark, sf_dir, split=_split):
        return _plain(br.count_split(_flat(spark, sf_dir), split))


RULE_COLS = {
    "fraud_os": "lower(os) NOT LIKE '%android%' AND lower(os) NOT LIKE '%ios%'",
    "fraud_ua_lang": "ua LIKE '%lang:%' AND ua NOT LIKE '%lang:ko%'",
    "fraud_emulator": "ua LIKE '%sdk%' AND ua LIKE '%x86%'",
}
RULE_BASE = flat_sql("bid", {"ua": REQUEST["ua"], "os": REQUEST["os"], **KEYS, **TIMES})
RULE_OUT = ["ua", "os", *br.KEYS, *br.TIMES]


def _rule_rows(df):
    return _plain(df).select("device.ua", "device.os", *br.KEYS, *br.TIMES)


@query("f3_expect_or_drop", f"SELECT * FROM ({RULE_BASE}) WHERE actiontime_date > '2024-01-10'")
def expect_or_drop(spark, sf_dir):
    kept = br.expect_or_drop(_flat(spark, sf_dir), "actiontime_date > DATE'2024-01-10'")
    return _rule_rows(kept)


for _mode, _op in (("all", "AND"), ("any", "OR")):

    @query(
        f"f4_fraud_{_mode}",
        f"SELECT * FROM ({RULE_BASE}) WHERE " + f" {_op} ".join(f"({r})" for r in RULE_COLS.values()),
    )
    def fraud_rows(spark, sf_dir, mode=_mode):
        return _rule_rows(br.fraud(_flat(spark, sf_dir), mode=mode))


@query(
    "f4_fraud_flags",
    "SELECT tid, actiontime_local, "
    + ", ".join(f"COALESCE({r}, false) AS {n}" for n, r in RULE_COLS.items())
    + f" FROM ({RULE_BASE})",
)
def fraud_flags(spark, sf_dir):
    return br.with_rule_flags(_flat(spark, sf_dir)).select("tid", "actiontime_local", *br.FRAUD_RULES)


IMP = flat_sql("imp", {
    "domain": FULL["url"], "bid_price": REQUEST["bid_price"], "win_price": PRICE,
    "InventoryIdx": FULL["InventoryIdx"], "bidrequest_type": REQUEST["bidrequest_type"], **HEAD,
})


def _imp(spark, sf_dir):
    return bronze(spark, sf_dir, "imp").select(
        F.col("BidStream.bundle_domain").alias("domain"), "BidStream.bid_price",
        "BidStream.win_price", "BidStream.InventoryIdx", "BidStream.bidrequest_type",
        "tid", "actiontime_local", "actiontime_date",
    )


@query(
    "a9_price_profile",
    f"""WITH s AS (SELECT domain, CAST(SUM(bid_price) AS DOUBLE) AS b, COUNT(bid_price) AS nb,
  SUM(win_price) AS w, COUNT(win_price) AS nw FROM ({IMP}) GROUP BY domain)
SELECT domain, b AS sum_bid_price, b / nb AS avg_bid_price, nb AS cnt_bid_price,
  CAST(w AS DOUBLE) AS sum_win_price, CAST(w AS DOUBLE) / nw AS avg_win_price,
  CAST(w * 1000 AS DOUBLE) AS sum_win_cpm, CAST(w AS DOUBLE) / nw * 1000 AS avg_win_cpm FROM s""",
)
def price_profile(spark, sf_dir):
    return ru.price_profile(_imp(spark, sf_dir), "domain")


@query(
    "a10_zero_split",
    """SELECT d = 0 AS is_zero, COUNT(*) AS cnt, CAST(SUM(d) AS DOUBLE) AS price_sum
FROM (SELECT CAST(l_discount AS DECIMAL(5,2)) AS d FROM lineitem) GROUP BY ALL""",
)
def zero_split(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select(F.expr("CAST(l_discount AS DECIMAL(5,2)) AS price"))
    out = ru.zero_split(lines, "price")
    return out.withColumn("price_sum", F.col("price_sum").cast("double"))


@query("a11_distinct_projection", f"SELECT DISTINCT domain, InventoryIdx FROM ({IMP})")
def distinct_projection(spark, sf_dir):
    return ru.distinct_of(_imp(spark, sf_dir), "domain", "InventoryIdx")


@query(
    "t1_top_domains",
    f"SELECT domain, COUNT(domain) AS cnt FROM ({IMP}) GROUP BY domain ORDER BY cnt DESC, domain LIMIT 10",
)
def top_domains(spark, sf_dir):
    return ru.top_k(_imp(spark, sf_dir), "domain", 10)


@query("t2_latest_event", "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def latest_event(spark, sf_dir):
    return ru.latest(read(spark, sf_dir, "events"), "ts", "event_id")


@query("t3_head_events", "SELECT * FROM events ORDER BY ts, event_id LIMIT 100")
def head_events(spark, sf_dir):
    return ru.head(read(spark, sf_dir, "events"), 100, "ts", "event_id")


@query(
    "n2_share_of_total",
    """SELECT c_mktsegment, COUNT(*) AS cnt, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM customer) * 100 AS ratio
FROM customer GROUP BY c_mktsegment""",
)
def share_of_total(spark, sf_dir):
    return ru.ratio_by(read(spark, sf_dir, "customer"), "c_mktsegment")


@query(
    "a12_sum_positive",
    """SELECT l_suppkey, l_returnflag, CAST(SUM(p) AS DOUBLE) AS margin FROM (
  SELECT l_suppkey, l_returnflag, CAST(l_discount - l_tax AS DECIMAL(9,2)) AS p FROM lineitem)
GROUP BY ALL HAVING SUM(p) > 0""",
)
def sum_positive(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_returnflag", F.expr("CAST(l_discount - l_tax AS DECIMAL(9,2)) AS margin")
    )
    out = ru.sum_positive(lines, ["l_suppkey", "l_returnflag"], "margin")
    return out.withColumn("margin", F.col("margin").cast("double"))


@query(
    "a13_cardinality",
    "SELECT COUNT(DISTINCT o_orderstatus) AS o_orderstatus, COUNT(DISTINCT o_orderpriority) AS o_orderpriority FROM orders",
)
def cardinality(spark, sf_dir):
    return ru.cardinality(read(spark, sf_dir, "orders"))


@query(
    "a17_sum_by",
    """SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS l_quantity,
  CAST(SUM(CAST(l_linenumber AS BIGINT)) AS BIGINT) AS l_linenumber FROM lineitem GROUP BY ALL""",
)
def sum_by(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("long"))
    return ru.sum_by(lines, ["l_returnflag", "l_linestatus"], ["l_quantity", "l_linenumber"])


@query("a18_label_counts", 'SELECT quality, COUNT(*) AS "count" FROM labels GROUP BY quality')
def label_counts(spark, sf_dir):
    return ru.label_counts(read(spark, sf_dir, "labels"), "quality")
