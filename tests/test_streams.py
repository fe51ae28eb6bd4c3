"""Streams over several micro-batches, with late and repeated events."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from adflow.session import temp_database, work_dir
from adflow.sources import readers as rd
from adflow.sources import sinks as sk
from adflow.streaming import streams as ss

T0 = datetime(2024, 1, 1, 10)
SCHEMA = "tid string, ts timestamp_ntz, adv int, price decimal(13,10)"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


class Topic:
    """A folder that receives files, read as a stream with one checkpoint."""

    def __init__(self, spark, label):
        self.spark = spark
        self.path = work_dir(spark, f"topic-{label}")
        self.out, self.checkpoint = work_dir(spark, "out"), work_dir(spark, "checkpoint")

    def add(self, *events):
        rows = [(tid, at(m), adv, None) for tid, m, adv in events]
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        return ss.event_time(rd.stream_parquet(self.spark, self.path, schema), "ts")

    def run(self, df, **options):
        ss.run_available(df, self.out, checkpoint=self.checkpoint, **options)
        return self.spark.read.schema(df.schema).parquet(self.out)


def test_dedup_over_batches_and_late_rows(spark):
    topic = Topic(spark, "dedup")
    make = lambda: ss.dedup_stream(topic.stream(), ["tid"], "ts", "1 hour").select("tid", "ts")
    topic.add(("a", 0, 1), ("a", 5, 1), ("b", 1, 1))
    assert topic.run(make()).count() == 2
    topic.add(("a", 20, 1), ("c", 200, 1))
    assert sorted(r["tid"] for r in topic.run(make()).collect()) == ["a", "b", "c"]
    # Past the watermark (200 - 60 minutes): dropped. "a" left the state: counted again.
    topic.add(("d", 30, 1), ("a", 210, 1))
    assert sorted(r["tid"] for r in topic.run(make()).collect()) == ["a", "a", "b", "c"]


def test_window_stats_close_after_the_watermark(spark):
    topic = Topic(spark, "window")
    make = lambda: ss.window_stats(topic.stream(), "1 hour", ["adv"], "ts", "1 hour")
    topic.add(("a", 0, 1), ("b", 10, 1), ("c", 70, 2))
    assert topic.run(make()).count() == 0
    topic.add(("d", 50, 1), ("e", 125, 1))
    got = topic.run(make()).collect()
    assert [(r["adv"], r["events"]) for r in got] == [(1, 3)]
    topic.add(("late", 59, 1), ("f", 400, 1))
    got = sorted((r["window_start"].hour, r["adv"], r["events"]) for r in topic.run(make()).collect())
    assert got == [(10, 1, 3), (11, 2, 1), (12, 1, 1)]


def test_count_stream_equals_batch_counts(spark):
    topic = Topic(spark, "count")
    topic.add(("a", 0, 1), ("a", 3, 1), ("b", 4, 1), ("a", 61, 1), ("z", 600, 9))
    got = topic.run(ss.count_stream(topic.stream(), "tid", ["adv"], "ts")).collect()
    assert sorted((r["window_start"].hour, r["count"]) for r in got) == [(10, 2), (11, 1)]


def test_attribution_bounds(spark):
    imp, clk = Topic(spark, "imp"), Topic(spark, "clk")
    imp.add(("in", 0, 1), ("edge", 0, 1), ("out", 0, 1), ("before", 10, 1), ("end", 900, 1))
    clk.add(("in", 30, 1), ("edge", 60, 1), ("out", 61, 1), ("before", 5, 1), ("end", 1500, 1))
    right = clk.stream().select(F.col("tid").alias("ctid"), F.col("ts").alias("ctime"))
    make = lambda how: ss.stream_attribution(
        imp.stream(), right, [("tid", "ctid")], "ts", "ctime", how=how
    ).select("tid", "ctid")
    inner = imp.run(make("inner"))
    assert sorted(r["tid"] for r in inner.collect()) == ["edge", "in"]
    clk.checkpoint, clk.out = work_dir(spark, "checkpoint"), work_dir(spark, "out")
    left = {r["tid"]: r["ctid"] for r in clk.run(make("left")).collect()}
    assert left == {"in": "in", "edge": "edge", "out": None, "before": None}


def test_restarted_batch_replaces_its_output(spark):
    path = work_dir(spark, "sink")
    write = ss.idempotent_batches(path)
    rows = spark.range(3).toDF("id")
    write(rows, 0)
    write(rows, 1)
    write(rows, 1)
    assert spark.read.parquet(path).count() == 6


def test_expectation_ledger_sums_batches(spark):
    topic = Topic(spark, "expect")
    book = work_dir(spark, "ledger")
    rules = {"known": "adv IN (1, 2)", "named": "tid <> 'x'"}
    batch = ss.expect_batches(topic.out, book, rules)
    topic.add(("a", 0, 1), ("x", 1, 2), ("b", 2, None))
    ss.run_available(topic.stream(), topic.out, topic.checkpoint, batch=batch)
    topic.add(("c", 3, 9))
    ss.run_available(topic.stream(), topic.out, topic.checkpoint, batch=batch)
    got = {r["rule"]: (r["passed"], r["dropped"]) for r in ss.ledger(spark, book).collect()}
    assert got == {"known": (2, 2), "named": (3, 1)}
    assert [r["tid"] for r in spark.read.parquet(topic.out).collect()] == ["a"]


def test_empty_batch_clears_its_earlier_output(spark):
    path = work_dir(spark, "sink")
    write = ss.idempotent_batches(path)
    rows = spark.range(3).toDF("id")
    write(rows, 0)
    write(rows, 1)
    write(rows.where("false"), 1)
    assert spark.read.parquet(path).count() == 3


def test_window_batches_replace_their_windows(spark, rows):
    name = f"{temp_database(spark, 'windows')}.t"
    sk.overwrite(spark.createDataFrame([], "ts timestamp, n int"), name)
    write = ss.window_batches(name, "ts")
    make = lambda *pairs: spark.createDataFrame([(at(m), n) for m, n in pairs], "ts timestamp, n int")
    write(make((0, 1), (60, 2)), 0)
    write(make((120, 3)), 1)
    write(make((0, 1), (60, 2), (120, 3)), 0)
    write(make(), 1)
    assert rows(spark.table(name), "n") == [(1,), (2,), (3,)]


def test_first_per_key_does_not_depend_on_files(spark):
    """All columns of the first event, whether events come in one file, in order, or backwards."""
    events = [("hot", m, m % 3) for m in range(0, 50)] + [("b", 7, 1), ("b", 3, 2), ("b", 3, 1), ("b", 90, 4), ("c", 200, 1), ("end", 900, 1)]
    want = sorted([("hot", at(0), 0), ("b", at(3), 1), ("b", at(90), 4), ("c", at(200), 1)])
    for cuts in ([events], [events[:20], events[20:54], events[54:]], [events[54:55], events[20:54][::-1], events[:20], events[55:]]):
        topic = Topic(spark, "first")
        for part in cuts:
            topic.add(*part)
        stream = ss.first_per_key(topic.stream(), ["tid"], "ts", "1 hour", ["adv"])
        got = topic.run(stream).select("tid", F.col("ts").cast("timestamp_ntz").alias("ts"), "adv")
        assert sorted(tuple(r) for r in got.collect()) == want


def test_first_per_key_has_no_python_and_folds_before_the_shuffle(spark):
    topic = Topic(spark, "plan")
    topic.add(("a", 0, 1))
    plan = ss.first_per_key(topic.stream(), ["tid"], "ts", "1 hour")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert spark.conf.get(ss.LOCAL_SESSIONS) == "true"


def test_ledger_of_a_plain_sink(spark):
    topic = Topic(spark, "plain")
    book = work_dir(spark, "ledger")
    ledger = ss.ExpectationLedger(spark, book, {"known": "adv IN (1, 2)", "named": "tid <> 'x'"})
    topic.add(("a", 0, 1), ("x", 1, 2), ("b", 2, None))
    ledger.run(ledger.watched(topic.stream()), topic.out, checkpoint=topic.checkpoint)
    topic.add(("c", 3, 9))
    ledger.run(ledger.watched(topic.stream()), topic.out, checkpoint=topic.checkpoint)
    got = {r["rule"]: (r["passed"], r["dropped"]) for r in ss.ledger(spark, book).collect()}
    assert got == {"known": (2, 2), "named": (3, 1)}
    assert spark.read.parquet(topic.out).count() == 4
