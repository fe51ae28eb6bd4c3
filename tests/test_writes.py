"""Repeatable writes, table jobs and skewed joins."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from adflow.operators import skew as sw
from adflow.operators.wash import intervals, wash
from adflow.session import temp_database, work_dir
from adflow.sources import catalog as ct
from adflow.sources import sinks as sk
from adflow.sources import versions as vs


@pytest.fixture()
def table(spark):
    name = f"{temp_database(spark, 'test')}.fact"
    df = spark.createDataFrame(
        [(date(2024, 1, d), d % 2, d * 10) for d in range(1, 7)] + [(None, 0, 70)], "day date, acc int, v int"
    )
    sk.overwrite(df.withColumn("half", F.when(F.col("day") < F.lit(date(2024, 1, 4)), "a").otherwise("b")), name, ["half"])
    return name


def _days(low, high):
    return (F.col("day") >= F.lit(date(2024, 1, low))) & (F.col("day") < F.lit(date(2024, 1, high)))


def test_replace_window_twice_is_once(spark, table, rows):
    new = spark.createDataFrame([(date(2024, 1, 3), 1, -3, "a"), (date(2024, 1, 4), 0, -4, "b")], "day date, acc int, v int, half string")
    expected = None
    for _ in range(2):
        sk.replace_window(new, table, _days(3, 5))
        got = rows(spark.table(table), "day", "v")
        assert expected in (None, got)
        expected = got
    assert sorted(v for _, v in got) == [-4, -3, 10, 20, 50, 60, 70]


def test_replace_window_keeps_rows_with_unknown_predicate(spark, table):
    sk.replace_window(spark.table(table).where("false"), table, _days(1, 31))
    assert [r["v"] for r in spark.table(table).collect()] == [70]
    assert [tuple(r) for r in sk.partitions(spark, table).collect()] == [("b",)]


def test_replace_window_scope(spark, table):
    sk.replace_window(spark.table(table).where("false"), table, _days(1, 31), scope={"acc": 1})
    assert sorted(r["v"] for r in spark.table(table).collect()) == [20, 40, 60, 70]


def test_replace_window_may_read_its_target(spark, table):
    doubled = spark.table(table).where(_days(2, 3)).withColumn("v", F.col("v") * 2)
    sk.replace_window(doubled, table, _days(2, 3))
    assert sorted(r["v"] for r in spark.table(table).collect()) == [10, 30, 40, 40, 50, 60, 70]


def test_replace_window_adds_a_new_partition(spark, table):
    new = spark.createDataFrame([(date(2024, 2, 1), 1, 1, "c")], "day date, acc int, v int, half string")
    sk.replace_window(new, table, F.col("day") >= F.lit(date(2024, 2, 1)))
    assert spark.table(table).count() == 8


def test_replace_window_without_partitions(spark, rows):
    name = f"{temp_database(spark, 'flat')}.t"
    sk.overwrite(spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string"), name)
    sk.replace_window(spark.createDataFrame([(2, "z")], "k int, v string"), name, F.col("k") >= 2)
    assert rows(spark.table(name)) == [(1, "a"), (2, "z"), (None, "c")]


def _failing(df):
    """The rows of ``df``, of which one fails when it is written."""
    return df.withColumn("v", F.when(F.col("v") == F.lit(df.first()["v"]), F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("v")))


@pytest.mark.parametrize("parts", [(), ("half",)])
@pytest.mark.parametrize("write", ["window", "overwrite", "refresh"])
def test_failed_write_leaves_the_table(spark, rows, parts, write):
    name = f"{temp_database(spark, 'fail')}.t"
    df = spark.createDataFrame([(k, k * 10, "ab"[k % 2]) for k in range(10)], "k int, v int, half string")
    sk.overwrite(df, name, parts)
    before = rows(spark.table(name), "k", "v", "half")
    bad = _failing(df.where("k > 5"))
    with pytest.raises(Exception, match="broken"):
        if write == "window":
            sk.replace_window(bad, name, F.col("k") > 5)
        elif write == "overwrite":
            sk.overwrite(bad, name, parts)
        else:
            sk.refresh_dim(bad, name)
    assert rows(spark.table(name), "k", "v", "half") == before
    sk.replace_window(df.where("k > 5").withColumn("v", F.lit(1)), name, F.col("k") > 5)
    assert spark.table(name).where("v = 1").count() == 4 and spark.table(name).count() == 10


def test_window_over_partitions_reads_none_of_them(spark, rows, monkeypatch):
    name = f"{temp_database(spark, 'whole')}.t"
    df = spark.createDataFrame([(date(2024, 1, d), d) for d in range(1, 6)] + [(None, 9)], "day date, v int")
    sk.overwrite(df.select("v", "day"), name, ["day"])
    asked = []
    one_of = sk._one_of
    monkeypatch.setattr(sk, "_one_of", lambda parts, values: asked.append(values) or one_of(parts, values))
    new = spark.createDataFrame([(-3, date(2024, 1, 3)), (-7, date(2024, 1, 7))], "v int, day date")
    sk.replace_window(new, name, _days(3, 5))
    assert sorted(v for (v,) in rows(spark.table(name), "v")) == [-7, -3, 1, 2, 5, 9]
    assert asked == []
    sk.replace_window(new.where("v = -3"), name, _days(3, 5))
    assert sorted(v for (v,) in rows(spark.table(name), "v")) == [-7, -3, 1, 2, 5, 9]


def test_overwrite_may_read_its_target(spark, rows):
    name = f"{temp_database(spark, 'self')}.t"
    sk.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), name)
    sk.overwrite(spark.table(name).where("k = 2"), name)
    assert rows(spark.table(name)) == [(2, "b")]


def test_adoption_that_stopped_is_finished(spark, rows, monkeypatch):
    """A table of someone else's is taken over once, in two statements."""
    name = f"{temp_database(spark, 'swap')}.t"
    spark.createDataFrame([(1, "a")], "k int, v string").write.saveAsTable(name)
    run = vs.statement
    monkeypatch.setattr(vs, "statement", lambda s, text: 1 / 0 if "RENAME TO" in text else run(s, text))
    more = spark.createDataFrame([(2, "b")], "k int, v string")
    with pytest.raises(ZeroDivisionError):
        sk.replace_window(more, name, F.col("k") == 2)
    monkeypatch.undo()
    sk.replace_window(more, name, F.col("k") == 2)
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]
    assert ct.list_tables(spark, [name.split(".")[0]]) == [tuple(name.split("."))]


def test_wash_makes_a_missing_table_with_partitions(spark):
    name = f"{temp_database(spark, 'wash')}.t"
    make = lambda low, high: spark.createDataFrame([(low.date(), 1)], "day date, v int")
    for _ in range(2):
        wash(spark, make, name, "day", datetime(2024, 1, 1), datetime(2024, 1, 3), by="day", partition_by=["day"])
    assert sk.partition_columns(spark, name) == ["day"]
    assert spark.table(name).count() == 2


def test_partition_tables_by_the_day_of_a_timestamp(spark):
    db = temp_database(spark, "stamp")
    spark.sql(f"CREATE TABLE {db}.t USING parquet AS SELECT id, TIMESTAMP'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS start FROM range(50)")
    assert ct.partition_tables(spark, db, ["t"], 10) == ["t"]
    assert sk.partitions(spark, f"{db}.t").count() == 3
    assert spark.table(f"{db}.t").count() == 50


def test_append_follows_the_table_column_order(spark, rows):
    name = f"{temp_database(spark, 'order')}.t"
    sk.append(spark.createDataFrame([(1, "a")], "k int, v string"), name)
    sk.append(spark.createDataFrame([("b", 2)], "v string, k int"), name)
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]


def test_write_sized(spark):
    path = work_dir(spark, "sized")
    sk.write_sized(spark.range(1000).toDF("id"), path, 100)
    files = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 10 and max(r["count"] for r in files) <= 100


def test_find_tables(spark):
    db = temp_database(spark, "find")
    for name in ("ad_stats", "ad_raw", "tt_ad_stats", "other"):
        spark.range(1).write.saveAsTable(f"{db}.{name}")
    assert ct.find_tables(spark, db, "full", ["ad_stats"]) == ["ad_stats"]
    assert ct.find_tables(spark, db, "contains", ["ad_"]) == ["ad_raw", "ad_stats"]
    assert ct.find_tables(spark, db, "regex", ["_stats$"]) == ["ad_stats", "tt_ad_stats"]
    with pytest.raises(ValueError):
        ct.find_tables(spark, db, "like", [])


def test_schema_diff(spark):
    a, b = temp_database(spark, "a"), temp_database(spark, "b")
    spark.sql(f"CREATE TABLE {a}.t USING parquet AS SELECT 1 AS x, 'q' AS y")
    spark.sql(f"CREATE TABLE {b}.t USING parquet AS SELECT 1L AS x, 'q' AS y")
    spark.sql(f"CREATE TABLE {a}.only USING parquet AS SELECT 1 AS x")
    assert [tuple(r) for r in ct.schema_diff(spark, a, b).orderBy("table").collect()] == [
        ("only", "*", "present", None), ("t", "x", "int", "bigint"),
    ]
    ct.sync_dev(spark, a, b)
    assert ct.schema_diff(spark, a, b).count() == 0


def test_partition_tables_skips_small_and_undated(spark):
    db = temp_database(spark, "part")
    spark.sql(f"CREATE TABLE {db}.big USING parquet AS SELECT id, DATE'2024-01-01' + CAST(id % 3 AS INT) AS event_date FROM range(50)")
    spark.sql(f"CREATE TABLE {db}.small USING parquet AS SELECT 1 AS id, DATE'2024-01-01' AS event_date")
    spark.sql(f"CREATE TABLE {db}.undated USING parquet AS SELECT id FROM range(50)")
    assert ct.partition_tables(spark, db, ["big", "small", "undated"], 10) == ["big"]
    assert sk.partition_columns(spark, f"{db}.big") == ["event_date"]
    assert spark.table(f"{db}.big").where("event_date = DATE'2024-01-02'").count() == 17


def _skewed(spark):
    """A third of the left rows share one key, another part has none."""
    left = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 50 = 1 THEN NULL ELSE id % 400 END AS k")
    right = spark.range(200).selectExpr("CAST(id AS BIGINT) AS k", "id * 10 AS v")
    return left, right


@pytest.mark.parametrize("how", ["left", "inner"])
def test_skew_join_equals_plain_join(spark, rows, how):
    left, right = _skewed(spark)
    assert rows(sw.skew_join(left, right, ["k"], how, salts=8, share=0.05)) == rows(left.join(right, ["k"], how))


def test_skew_join_spreads_the_hot_key(spark):
    left, _ = _skewed(spark)
    hot = sw.frequent(left, ["k"], F.xxhash64("k"), 0.05)
    assert len(hot) == 1
    spread = sw._spread(left, F.xxhash64("k").isin(hot), 8).where("k = 7").groupBy("__salt").count().collect()
    assert len(spread) == 8 and max(r["count"] for r in spread) < 250


def test_skew_join_with_different_key_types(spark, rows):
    left, right = _skewed(spark)
    narrow = right.withColumn("k", F.col("k").cast("int"))
    got = sw.skew_join(left, narrow, ["k"], "left", salts=4, share=0.05)
    assert rows(got, "id", "v") == rows(left.join(right, ["k"], "left"), "id", "v")


def test_fanout_left_join_equals_plain_join(spark, rows):
    right, left = _skewed(spark)
    right = right.withColumnRenamed("id", "rid")
    got = sw.fanout_left_join(left, right, ["k"], salts=8, share=0.05)
    assert rows(got, "k", "v", "rid") == rows(left.join(right, ["k"], "left"), "k", "v", "rid")


def test_null_keys_do_not_meet_in_one_task(spark):
    left = spark.range(20_000).select(F.when(F.col("id") % 100 == 0, F.col("id")).alias("k"), "id")
    right = spark.range(200).select((F.col("id") * 100).alias("k"), F.lit(1).alias("v"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = sw.fanout_left_join(left, right, ["k"], salts=16)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 20_000 and max(sizes) < 10_000


def test_assert_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    sw.assert_unique(df, ["k", "v"])
    with pytest.raises(ValueError):
        sw.assert_unique(df, ["k"])


def test_intervals():
    a, b = datetime(2024, 1, 1), datetime(2024, 1, 4)
    assert intervals(a, b, "interval") == [(a, b)]
    assert [d[0].day for d in intervals(a, b, "day")] == [1, 2, 3]
