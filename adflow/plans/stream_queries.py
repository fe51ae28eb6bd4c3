"""Streams over the event table, run until what has arrived is processed."""

from __future__ import annotations

from pyspark.sql import functions as F

from adflow.operators import funnel as fn
from adflow.plans.funnel_queries import BUCKET
from adflow.plans.quality_queries import RULES
from adflow.plans.registry import query
from adflow.plans.views import COARSE, HEAD, KIND_OF, PRICE, bronze, first_sql, read, silver_sql
from adflow.session import temp_database, work_dir
from adflow.sources import readers as rd
from adflow.sources import sinks as sk
from adflow.streaming import streams as ss

EVENTS = "SELECT * FROM events"


def _stream(spark, sf_dir):
    """The event file or folder as a stream; the glob lets it be either."""
    schema = read(spark, sf_dir, "events").schema
    return rd.stream_parquet(spark, f"{sf_dir.rstrip('/')}/event[s].parquet", schema)


def _kind(spark, sf_dir, kind):
    rows = _stream(spark, sf_dir).where(F.col("event_type") == KIND_OF[kind])
    return ss.event_time(rows, "ts").select(
        F.expr(HEAD["tid"]).alias("tid"), "ts", F.expr("CAST(user_id % 5 AS INT)").alias("ad_adv"),
        F.expr(PRICE).alias("price"),
    )


def _ntz(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _run(df, spark, label, **options):
    path = work_dir(spark, label)
    ss.run_available(df, path, **options)
    return spark.read.schema(df.schema).parquet(path)


@query("s1_stream_json", EVENTS)
def stream_json(spark, sf_dir):
    base = work_dir(spark, "topic")
    events = read(spark, sf_dir, "events")
    landed = events.withColumn("minute", F.minute("ts") - F.minute("ts") % 15)
    landed.write.options(**rd.MICROS).partitionBy("minute").json(base, compression="gzip")
    stream = rd.stream_json(spark, f"{base}/minute=*", events.schema, max_files=3)
    return _run(stream, spark, "s1")


@query("s2_stream_table", "SELECT event_id, ts, event_type FROM events WHERE event_type = 'view'")
def stream_table(spark, sf_dir):
    table = f"{temp_database(spark, 'bronze')}.events"
    sk.overwrite(read(spark, sf_dir, "events"), table)
    rows = rd.stream_table(spark, table).where("event_type = 'view'").select("event_id", "ts", "event_type")
    return _run(rows, spark, "s2")


CLOSED = "epoch_us(window_end) <= (SELECT epoch_us(MAX(ts)) // 1000 * 1000 FROM events WHERE event_type = '{kind}') - {delay} * 3600000000"


def _first_sql(kind):
    """Events of a key that follow each other within the delay are one; its first by time counts, once
    the watermark (the latest event less the delay, in whole milliseconds) has passed its end."""
    hours = int(ss.DEDUP_DELAY[kind].split()[0])
    return f"""WITH e AS (SELECT {HEAD['tid']} AS tid, ts, CAST(user_id % 5 AS INT) AS ad_adv, {PRICE} AS price FROM events WHERE event_type = '{KIND_OF[kind]}'),
b AS (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY tid ORDER BY ts) >= ts - INTERVAL {hours} HOUR THEN 0 ELSE 1 END AS new FROM e),
s AS (SELECT *, SUM(new) OVER (PARTITION BY tid ORDER BY ts) AS session FROM b),
f AS (SELECT *, row_number() OVER (PARTITION BY tid, session ORDER BY ts, ad_adv, price) AS rn,
  MAX(ts) OVER (PARTITION BY tid, session) + INTERVAL {hours} HOUR AS window_end FROM s)
SELECT tid, ts, ad_adv, CAST(price AS DOUBLE) AS price FROM f WHERE rn = 1 AND {CLOSED.format(kind=KIND_OF[kind], delay=hours)}"""


for _k in fn.KINDS:

    @query(f"z1_dedup_{_k}", _first_sql(_k))
    def dedup(spark, sf_dir, kind=_k):
        rows = ss.first_per_key(_kind(spark, sf_dir, kind), ["tid"], "ts", ss.DEDUP_DELAY[kind], ["ad_adv", "price"])
        return _run(_ntz(rows.withColumn("price", F.col("price").cast("double")), "ts"), spark, "z1")


@query(
    "z1_first_per_hour",
    f"""SELECT tid, ts, ad_adv FROM (SELECT {HEAD['tid']} AS tid, ts, CAST(user_id % 5 AS INT) AS ad_adv, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
  row_number() OVER (PARTITION BY {HEAD['tid']}, date_trunc('hour', ts) ORDER BY ts) AS rn FROM events WHERE event_type = 'view')
WHERE rn = 1 AND {CLOSED.format(kind='view', delay=1)}""",
)
def first_per_hour(spark, sf_dir):
    out = ss.first_per_window(_kind(spark, sf_dir, "bid").drop("price"), ["tid"], "ts")
    return _run(_ntz(out.drop("window"), "ts"), spark, "z1")


@query(
    "z2_count_stream",
    f"""SELECT * FROM (SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
  CAST(user_id % 5 AS INT) AS ad_adv, COUNT(DISTINCT {HEAD['tid']}) AS "count" FROM events WHERE event_type = 'view' GROUP BY ALL)
WHERE {CLOSED.format(kind='view', delay=1)}""",
)
def count_stream(spark, sf_dir):
    out = ss.count_stream(_kind(spark, sf_dir, "bid"), "tid", ["ad_adv"], "ts")
    return _run(_ntz(out, "window_start", "window_end"), spark, "z2")


@query(
    "z2_count_batch",
    f"""SELECT CAST(user_id % 5 AS INT) AS ad_adv, COUNT(DISTINCT {HEAD['tid']}) AS "count" FROM events WHERE event_type = 'view' GROUP BY ALL""",
)
def count_batch(spark, sf_dir):
    """The same counts as a recomputed table: drop duplicates, then count."""
    rows = read(spark, sf_dir, "events").where("event_type = 'view'").select(
        F.expr(HEAD["tid"]).alias("tid"), F.expr("CAST(user_id % 5 AS INT)").alias("ad_adv")
    )
    return rows.dropDuplicates(["tid"]).groupBy("ad_adv").count()


WINDOW_SQL = f"""SELECT * FROM (SELECT {{start}} AS window_start, {{start}} + INTERVAL {{minutes}} MINUTE AS window_end, CAST(user_id % 5 AS INT) AS ad_adv,
  COUNT(*) AS events, CAST(SUM({PRICE}) AS DOUBLE) AS price_sum FROM events WHERE event_type = 'click' GROUP BY ALL)
WHERE {CLOSED.format(kind='click', delay=2)}"""


def _window(spark, sf_dir, size, **options):
    out = ss.window_stats(_kind(spark, sf_dir, "imp"), size, ["ad_adv"], "ts", "2 hours", "price")
    out = _ntz(out.withColumn("price_sum", F.col("price_sum").cast("double")), "window_start", "window_end")
    return out


for _size, _minutes, _start in (("5 minutes", 5, BUCKET[5]), ("1 hour", 60, BUCKET[60]), ("1 day", 1440, "date_trunc('day', ts)")):

    @query(f"z3_window_{_minutes}m", WINDOW_SQL.format(start=_start, minutes=_minutes))
    def window(spark, sf_dir, size=_size):
        return _run(_window(spark, sf_dir, size), spark, "z3")


@query("z8_idempotent_batches", WINDOW_SQL.format(start=BUCKET[60], minutes=60))
def idempotent_batches(spark, sf_dir):
    """The stream runs a second time from the start into the same folder."""
    path = work_dir(spark, "z8")
    for _ in range(2):
        ss.run_available(_window(spark, sf_dir, "1 hour"), path, batch=ss.idempotent_batches(path))
    return spark.read.parquet(path).drop("batch_id")


@query("z8_replace_window", WINDOW_SQL.format(start=BUCKET[60], minutes=60))
def replace_window_batches(spark, sf_dir):
    """Closed windows replace those of a table; the stream runs twice from the start."""
    table = f"{temp_database(spark, 'stats')}.hourly"
    out = _window(spark, sf_dir, "1 hour").withColumn("day", F.to_date("window_start"))
    sk.overwrite(spark.createDataFrame([], out.schema), table, ["day"])
    for _ in range(2):
        ss.run_available(out, work_dir(spark, "z8"), batch=ss.window_batches(table, "window_start"))
    return spark.table(table).drop("day")


@query(
    "z6_stream_expectations",
    " UNION ALL ".join(
        f"SELECT '{n}' AS rule, COUNT(*) FILTER (WHERE {r}) AS passed, COUNT(*) - COUNT(*) FILTER (WHERE {r}) AS dropped FROM events"
        for n, r in RULES.items()
    ),
)
def stream_expectations(spark, sf_dir):
    kept, book = work_dir(spark, "z6"), work_dir(spark, "ledger")
    ss.run_available(_stream(spark, sf_dir), kept, batch=ss.expect_batches(kept, book, RULES))
    return ss.ledger(spark, book)


@query(
    "q9_stream_ledger",
    " UNION ALL ".join(
        f"SELECT '{n}' AS rule, COUNT(*) FILTER (WHERE {r}) AS passed, COUNT(*) - COUNT(*) FILTER (WHERE {r}) AS dropped FROM events"
        for n, r in RULES.items()
    ),
)
def stream_ledger(spark, sf_dir):
    """A stream into plain files, counted by what its progress reports say."""
    book = work_dir(spark, "ledger")
    ledger = ss.ExpectationLedger(spark, book, RULES)
    ledger.run(ledger.watched(_stream(spark, sf_dir)), work_dir(spark, "q9"))
    return ss.ledger(spark, book)


@query("z6_stream_kept_rows", f"SELECT * FROM events WHERE {' AND '.join(f'({r})' for r in RULES.values())}")
def stream_kept_rows(spark, sf_dir):
    kept, book = work_dir(spark, "z6"), work_dir(spark, "ledger")
    ss.run_available(_stream(spark, sf_dir), kept, batch=ss.expect_batches(kept, book, RULES))
    return spark.read.parquet(kept).drop("batch_id")


@query("z7_backfill", "SELECT event_id, ts, event_type, CAST(CAST(ts AS DATE) AS STRING) AS day FROM events")
def backfill(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_id", "ts", "event_type", F.to_date("ts").alias("day"))
    landed = work_dir(spark, "landed")
    events.write.options(**rd.MICROS).json(landed)
    table = f"{temp_database(spark, 'bronze')}.events"
    broken = F.col("day").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-12").cast("date"))
    sk.overwrite(events.where(~broken | (F.col("event_type") == "view")), table, ["day"])
    ss.backfill(spark, landed, table, broken, events.schema)
    return spark.table(table).withColumn("day", F.col("day").cast("string"))


@query(
    "z7_backfill_widened",
    """SELECT event_id, ts, event_type, CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' THEN value END AS value,
  CAST(user_id AS BIGINT) AS user_id, CAST(CAST(ts AS DATE) AS STRING) AS day FROM events""",
)
def backfill_widened(spark, sf_dir):
    """The landed files have a column more than the table, and a wider type of another."""
    events = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    landed = work_dir(spark, "landed")
    full = events.select("event_id", "ts", "event_type", F.col("value").cast("double").alias("value"), F.col("user_id").cast("long").alias("user_id"), "day")
    full.write.options(**rd.MICROS).json(landed)
    table = f"{temp_database(spark, 'bronze')}.events"
    broken = F.col("day").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-12").cast("date"))
    old = events.select("event_id", "ts", "event_type", F.col("user_id").cast("int").alias("user_id"), "day")
    sk.overwrite(old.where(~broken | (F.col("event_type") == "view")), table, ["day"])
    ss.backfill(spark, landed, table, broken, full.schema, widen=True)
    return spark.table(table).withColumn("day", F.col("day").cast("string"))


# --- joins of streams ------------------------------------------------------

END = "end of the fixture"


def _silver(spark, sf_dir, kind, attributes=("ad_adv",)):
    """First event per transaction and hour, landed and read back as a stream.

    A last file holds one event of a month later, which moves the watermark past all others:
    so the stream releases every row. It carries the transaction ``END``.
    """
    rows = fn.first_events(fn.silver(bronze(spark, sf_dir, kind, True), kind, 60), kind)
    columns = [f"{kind}time", *attributes, "tid"] + (["Revenue"] if kind == "imp" else [])
    # One event per transaction and hour: the hour joins the key.
    rows = rows.withColumn("tid", F.concat_ws("-", "tid", F.date_format("Date", "HH"))).select(*columns)
    path = work_dir(spark, f"silver-{kind}")
    rows.write.parquet(path)
    # With real attributes: rows with NULL keys may be dropped before the watermark sees them.
    closing = spark.read.parquet(path).orderBy(F.desc(f"{kind}time"), "tid").limit(1).withColumns({
        "tid": F.lit(END), f"{kind}time": F.expr(f"{kind}time + INTERVAL 30 DAYS"),
    })
    closing.write.mode("append").parquet(path)
    return ss.event_time(rd.stream_parquet(spark, path, rows.schema), f"{kind}time")


def _silver_cte():
    parts = []
    for kind in fn.KINDS:
        price = ", Revenue" if kind == "imp" else ""
        parts += [
            f"{kind}_s AS ({silver_sql(kind, BUCKET[60], True)})",
            f"{kind}_f AS ({first_sql(kind + '_s', kind)})",
            f"{kind} AS (SELECT concat(tid, '-', strftime(\"Date\", '%H')) AS tid, {kind}time, {', '.join(fn.ATTRIBUTES)}{price} FROM {kind}_f)",
        ]
    return "WITH " + ",\n".join(parts)


IN_TIME = "{b}time >= {a}time AND {b}time <= {a}time + INTERVAL 1 HOUR"


@query(
    "j4_stream_attribution",
    f"""{_silver_cte()} SELECT imp.tid AS tid, imptime, clktime, CAST(Revenue AS DOUBLE) AS Revenue FROM imp JOIN clk
ON imp.tid = clk.tid AND {IN_TIME.format(a='imp', b='clk')}""",
)
def stream_attribution(spark, sf_dir):
    clicks = _silver(spark, sf_dir, "clk").withColumnsRenamed({"tid": "clk_tid"}).drop("ad_adv")
    joined = ss.stream_attribution(
        _silver(spark, sf_dir, "imp"), clicks, [("tid", "clk_tid")], "imptime", "clktime"
    )
    rows = joined.select("tid", "imptime", "clktime", F.col("Revenue").cast("double"))
    return _run(_ntz(rows, "imptime", "clktime"), spark, "j4").where(F.col("tid") != END)


SAME = {k: " AND ".join(f"bid.{a} = {k}.{a}" for a in fn.ATTRIBUTES) for k in ("imp", "clk")}


@query(
    "j5_stream_funnel",
    f"""{_silver_cte()} SELECT bid.tid AS tid, bid.ad_adv AS ad_adv, bid.url AS url, bidtime, imptime, clktime, CAST(Revenue AS DOUBLE) AS Revenue,
  CAST(trunc((epoch_us(clktime) - epoch_us(imptime)) / 1000000.0) AS BIGINT) AS "ITCT"
FROM bid LEFT JOIN imp ON bid.tid = imp.tid AND {SAME['imp']} AND {IN_TIME.format(a='bid', b='imp')}
LEFT JOIN clk ON bid.tid = clk.tid AND {SAME['clk']} AND {IN_TIME.format(a='imp', b='clk')}""",
)
def stream_funnel(spark, sf_dir):
    """Every bid, joined on the transaction and all twelve attributes."""
    rows = ss.funnel_stream(
        *[_silver(spark, sf_dir, k, fn.ATTRIBUTES) for k in fn.KINDS], attributes=fn.ATTRIBUTES
    )
    rows = rows.select("tid", "ad_adv", "url", "bidtime", "imptime", "clktime", F.col("Revenue").cast("double"), "ITCT")
    return _run(_ntz(rows, "bidtime", "imptime", "clktime"), spark, "j5").where(F.col("tid") != END)
