"""Structured Streaming forms of the event jobs.

Every stateful operator is bounded by a watermark. Event times arrive without a
zone and are read in the session's zone, since watermarks need that type.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from adflow.functions.timewin import between_seconds
from adflow.operators.quality import observed
from adflow.session import work_dir
from adflow.sources.readers import read_json
from adflow.sources.sinks import replace_window

# How long each event kind may be repeated.
DEDUP_DELAY = {"bid": "1 hour", "imp": "2 hours", "clk": "3 hours"}


def event_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp") for c in columns})


def dedup_stream(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """One event per key within the delay, the first that arrives, at once; older keys leave
    the state.

    Every event goes through the shuffle. ``first_per_key`` folds before it, and its result
    does not depend on the order of arrival.
    """
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


# Lets a task fold the events of a key before the shuffle.
LOCAL_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def first_per_key(
    df: DataFrame, keys: Sequence[str], ts: str, delay: str, ties: Sequence[str] = ()
) -> DataFrame:
    """The earliest event of each key, as long as its events follow within the delay of each
    other; emitted once no more can follow.

    A session per key, with its first event by time and ``ties``: the same rows whatever
    files the events come in. As an aggregate it folds in the tasks, so a key that a third
    of all events have sends a row per task.
    """
    df.sparkSession.conf.set(LOCAL_SESSIONS, "true")
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(ts, *ties) if ties else F.col(ts)
    first = F.min_by(F.struct(*rest), order).alias("first")
    grouped = df.withWatermark(ts, delay).groupBy(F.session_window(ts, delay), *keys).agg(first)
    return grouped.select(*keys, *[F.col(f"first.{c}").alias(c) for c in rest]).select(*df.columns)


def first_per_window(
    df: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 hour", size: str = "1 hour",
    ties: Sequence[str] = (),
) -> DataFrame:
    """First event per key and tumbling window, emitted when the window closes.

    The batch job's "first per transaction and bucket" as a stream. Being an
    aggregate it folds repeats on the map side, so a key with very many events
    sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(ts, *ties) if ties else F.col(ts)
    first = F.min_by(F.struct(*rest), order).alias("first")
    grouped = df.withWatermark(ts, delay).groupBy(F.window(ts, size), *keys).agg(first)
    return grouped.select("window", *keys, *[F.col(f"first.{c}").alias(c) for c in rest])


def count_stream(
    df: DataFrame, key: str, dims: Sequence[str], ts: str, delay: str = "1 hour",
    size: str = "1 hour",
) -> DataFrame:
    """Transactions per window and dimensions, each counted once, at its first event."""
    once = first_per_window(df.select(key, ts, *dims), [key], ts, delay, size)
    counted = once.groupBy(F.window(F.window_time("window"), size), *dims).agg(
        F.count("*").alias("count")
    )
    return _flat_window(counted, dims, ["count"])


def window_stats(
    df: DataFrame, size: str, dims: Sequence[str], ts: str, delay: str, price: str | None = None
) -> DataFrame:
    """Events (and price) per tumbling window, emitted once the window is closed."""
    aggs = {"events": F.count("*")}
    if price:
        aggs["price_sum"] = F.sum(price)
    grouped = df.withWatermark(ts, delay).groupBy(F.window(ts, size), *dims)
    return _flat_window(grouped.agg(*[c.alias(n) for n, c in aggs.items()]), dims, list(aggs))


def _flat_window(df: DataFrame, dims: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *dims, *measures,
    )


def _within(later: str, earlier: str, bound: str) -> Column:
    return F.expr(f"{later} >= {earlier} AND {later} <= {earlier} + INTERVAL {bound}")


def stream_attribution(
    left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], left_ts: str,
    right_ts: str, bound: str = "1 hour", how: str = "inner",
    delays: tuple[str, str] = ("2 hours", "3 hours"),
) -> DataFrame:
    """Right events up to ``bound`` after the left one, on equal keys.

    Both sides carry a watermark, so state is kept for the bound and the delay
    only; ``how="left"`` emits left events without a match when that is certain.
    Feed it de-duplicated streams: then a key has one event a side, not pairs.
    """
    cond = _within(right_ts, left_ts, bound)
    for a, b in keys:
        cond = cond & (F.col(a) == F.col(b))
    return left.withWatermark(left_ts, delays[0]).join(
        right.withWatermark(right_ts, delays[1]), cond, how
    )


def funnel_stream(
    bid: DataFrame, imp: DataFrame, clk: DataFrame, bound: str = "1 hour",
    attributes: Sequence[str] = (),
) -> DataFrame:
    """Bids with the impression and the click that follow within the bound each.

    Two outer joins on event time. A stream may carry one event time into a
    join, so the impression time goes on as a plain value and the click is also
    bound to the bid, by twice the bound, which follows from the other two.
    Inputs are silver rows with ``bidtime``, ``imptime`` and ``clktime``.
    """
    delays = list(DEDUP_DELAY.values())
    renamed = {
        kind: df.select(
            F.col(f"{kind}time"), F.col("tid").alias(f"{kind}_tid"),
            *[F.col(a).alias(f"{kind}_{a}") for a in attributes],
            *([F.col("Revenue")] if kind == "imp" else []),
        )
        for kind, df in (("imp", imp), ("clk", clk))
    }
    first = bid.withWatermark("bidtime", delays[0]).join(
        renamed["imp"].withWatermark("imptime", delays[1]),
        _keys("tid", "imp", attributes) & _within("imptime", "bidtime", bound), "left",
    )
    first = first.select(
        *bid.columns, "Revenue", F.timestamp_micros(F.unix_micros("imptime")).alias("imptime")
    )
    in_time = _within("clktime", "imptime", bound) & F.expr(
        f"clktime >= bidtime AND clktime <= bidtime + INTERVAL {bound} + INTERVAL {bound}"
    )
    both = first.join(
        renamed["clk"].withWatermark("clktime", delays[2]),
        _keys("tid", "clk", attributes) & in_time, "left",
    )
    return both.select(
        *bid.columns, "imptime", "clktime", "Revenue",
        between_seconds(F.col("imptime"), F.col("clktime")).alias("ITCT"),
    )


def _keys(tid: str, kind: str, attributes: Sequence[str]) -> Column:
    cond = F.col(tid) == F.col(f"{kind}_tid")
    for a in attributes:
        cond = cond & (F.col(a) == F.col(f"{kind}_{a}"))
    return cond


def expect_batches(
    path: str, ledger_path: str, rules: Mapping[str, str]
) -> Callable[[DataFrame, int], None]:
    """Sink for ``foreachBatch``: keep rows meeting every rule, and count per rule.

    Counts are taken while the batch is written and stored per batch, so the
    ledger covers all batches and a batch that runs again is counted once.
    """
    keep = idempotent_batches(path)
    book = idempotent_batches(ledger_path)

    def write(rows: DataFrame, batch_id: int) -> None:
        watched, counts = observed(rows, f"batch {batch_id}", rules)
        passing = watched
        for rule in rules.values():
            passing = passing.where(rule)
        keep(passing, batch_id)
        got = counts.get
        entries = [(name, got[name], got["rows"] - got[name]) for name in rules]
        book(rows.sparkSession.createDataFrame(entries, LEDGER), batch_id)

    return write


LEDGER = "rule string, passed bigint, dropped bigint"


class ExpectationLedger(StreamingQueryListener):
    """Counts per rule of any stream, whatever its sink: those that ``watched`` observes.

    Spark reports them with the progress of each batch. They are stored per query and batch, so
    a batch that runs again is counted once. The driver keeps no more than one report.
    """

    def __init__(self, spark: SparkSession, path: str, rules: Mapping[str, str], name: str = "rules"):
        self.spark, self.path, self.rules, self.name = spark, path, dict(rules), name
        self.ended = threading.Event()
        self.failed: Exception | None = None

    def watched(self, df: DataFrame) -> DataFrame:
        """``df``, its rows counted per rule on their way to the sink."""
        passed = [F.count_if(F.expr(rule)).alias(n) for n, rule in self.rules.items()]
        return df.observe(self.name, F.count(F.lit(1)).alias("rows"), *passed)

    def run(self, df: DataFrame, path: str, **options):
        """``run_available`` under this ledger; returns when all reports are stored."""
        self.ended.clear()
        self.spark.streams.addListener(self)
        try:
            done = run_available(df, path, **options)
            if not self.ended.wait(60):
                raise TimeoutError("the stream has ended, its reports have not come")
        finally:
            self.spark.streams.removeListener(self)
        if self.failed:
            raise self.failed
        return done

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        got = event.progress.observedMetrics.get(self.name)
        if got is None:
            return
        entries = [(n, got[n], got["rows"] - got[n]) for n in self.rules]
        try:
            self.spark.createDataFrame(entries, LEDGER).coalesce(1).write.mode("overwrite").parquet(
                f"{self.path}/query_id={event.progress.id}/batch_id={event.progress.batchId}")
        except Exception as exc:  # the listener's thread: told to the one that waits
            self.failed = exc

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """Passed and dropped rows per rule over all batches."""
    return spark.read.parquet(ledger_path).groupBy("rule").agg(
        F.sum("passed").alias("passed"), F.sum("dropped").alias("dropped")
    )


def run_available(
    df: DataFrame, path: str, checkpoint: str | None = None, partition_by: Sequence[str] = (),
    batch: Callable[[DataFrame, int], None] | None = None,
):
    """Process what has arrived, however long that takes. Returns the finished query.

    With the same checkpoint a later call continues where this one ended.
    """
    checkpoint = checkpoint or work_dir(df.sparkSession, "checkpoint")
    writer = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if batch:
        running = writer.foreachBatch(batch).start()
    else:
        writer = writer.format("parquet").outputMode("append")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        running = writer.start(path)
    running.awaitTermination()
    return running


def idempotent_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Sink for ``foreachBatch``: a batch that runs again replaces its own folder.

    Also with no rows: then what an earlier run of the batch left is gone.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def window_batches(table: str, ts: str) -> Callable[[DataFrame, int], None]:
    """Sink for ``foreachBatch``: the event windows of a batch replace those of the table.

    For closed windows, which come in order of time: the windows of a batch are then all
    of its span. A batch that runs again, or a stream that starts anew and groups its files
    in another way, leaves the same rows.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        span = rows.agg(F.min(ts).alias("first"), F.max(ts).alias("last")).first()
        if span["first"] is not None:
            replace_window(rows, table, F.col(ts).between(F.lit(span["first"]), F.lit(span["last"])))
        rows.unpersist()

    return write


def backfill(
    spark: SparkSession, paths: str, table: str, window: Column, schema, widen: bool = False
) -> None:
    """Reload a broken window of a bronze table from its landed files, in one change.

    ``widen=True`` adds columns that ``schema`` has and the table lacks, and takes over wider
    types; rows outside the window have NULL there.
    """
    rows = read_json(spark, paths, schema).where(window)
    replace_window(rows, table, window, widen=widen)
