"""Tables behind a pointer: one statement per change, odd partition values, wider schemas."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from adflow.session import temp_database, work_dir
from adflow.sources import readers as rd
from adflow.sources import sinks as sk
from adflow.sources import versions as vs
from adflow.streaming import streams as ss

ODD = ["null", "O'Neil", None, "a=b/c", "__HIVE_DEFAULT_PARTITION", 'say "x"', "back\\slash", "50%", " blank ", "日本"]


@pytest.fixture()
def name(spark):
    return f"{temp_database(spark, 'versions')}.t"


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "v int, p string")


def held(spark, name):
    return sorted(((r["v"], r["p"]) for r in spark.table(name).collect()), key=str)


def test_odd_partition_values_survive(spark, name):
    sk.overwrite(frame(spark, [(k, p) for k, p in enumerate(ODD)]), name, ["p"])
    assert held(spark, name) == sorted(((k, p) for k, p in enumerate(ODD)), key=str)
    # Every second row goes and comes back larger; a third change removes old files.
    for base in (100, 200, 300):
        new = [(base + k, p) for k, p in enumerate(ODD) if k % 2]
        sk.replace_window(frame(spark, new), name, F.col("v") % 2 == 1)
        want = [(k, p) for k, p in enumerate(ODD) if k % 2 == 0] + new
        assert held(spark, name) == sorted(want, key=str)
    gone = [(500 + k, p) for k, p in enumerate(ODD)]
    for p in ODD:
        sk.replace_window(frame(spark, [r for r in gone if r[1] == p]), name, F.col("p").eqNullSafe(F.lit(p)))
    assert held(spark, name) == sorted(gone, key=str)
    assert sk.partitions(spark, name).count() == len(ODD)


def test_window_over_other_columns_finds_all_their_partitions(spark, name):
    """Partitions whose first row alone is outside of the window too."""
    sk.overwrite(frame(spark, [(k, p) for p in ("a", "b", "url") for k in range(5)]), name, ["p"])
    sk.replace_window(frame(spark, [(9, "b")]), name, F.col("v") >= 3)
    assert held(spark, name) == sorted([(k, p) for p in ("a", "b", "url") for k in range(3)] + [(9, "b")], key=str)


def test_rows_beside_a_partition_called_null(spark, name):
    sk.overwrite(frame(spark, [(1, "null"), (2, "x")]), name, ["p"])
    sk.replace_window(frame(spark, [(9, "null"), (8, None)]), name, F.col("p") == "x")
    assert held(spark, name) == sorted([(1, "null"), (9, "null"), (8, None)], key=str)


CHANGES = {
    "window": lambda spark, name: sk.replace_window(frame(spark, [(20, "a"), (21, "c")]), name, F.col("v") >= 2),
    "partitions": lambda spark, name: sk.replace_window(frame(spark, [(20, "a")]), name, F.col("p") == "a"),
    "append": lambda spark, name: sk.append(frame(spark, [(20, "b")]), name),
    "overwrite": lambda spark, name: sk.overwrite(frame(spark, [(20, "b")]).withColumn("x", F.lit(1)), name, ["p"]),
    "widened": lambda spark, name: sk.append(frame(spark, [(20, "b")]).withColumn("v", F.col("v").cast("long")), name, widen=True),
}


@pytest.mark.parametrize("change, parts", [(c, ["p"]) for c in CHANGES] + [("window", []), ("append", [])])
def test_a_stop_at_any_statement_leaves_old_or_new(spark, monkeypatch, change, parts):
    """Readers see the content before or after; the repeated change goes through; nothing else stays."""
    run, write = vs.statement, vs.sized
    stop = 0
    while True:
        name = f"{temp_database(spark, 'stops')}.t"
        sk.overwrite(frame(spark, [(1, "a"), (2, "a"), (3, "b")]), name, parts)
        for _ in range(2):  # so that old versions are removed too
            sk.replace_window(frame(spark, [(1, "a")]), name, F.col("v") == 1)
        before, left = held(spark, name), [stop]

        def step(spark, text):
            left[0] -= 1
            if left[0] < 0:
                raise RuntimeError("stopped")
            return run(spark, text)

        monkeypatch.setattr(vs, "statement", step)
        try:
            CHANGES[change](spark, name)
            stopped = False
        except RuntimeError:
            stopped = True
        monkeypatch.setattr(vs, "statement", run)
        seen = held(spark, name)
        if not stopped:
            break
        again = f"{name}2"
        sk.overwrite(frame(spark, before), again, parts)
        CHANGES[change](spark, again)
        assert seen in (before, held(spark, again))
        vs.vacuum(spark, name)
        assert held(spark, name) == seen
        stop += 1
    assert stop >= 1


def test_statements_do_not_grow_with_partitions(spark, monkeypatch, name):
    asked = []
    run = vs.statement
    sk.overwrite(frame(spark, [(k, f"p{k % 60}") for k in range(240)]), name, ["p"])
    monkeypatch.setattr(vs, "statement", lambda s, text: asked.append(text) or run(s, text))
    for _ in range(3):
        asked.clear()
        sk.replace_window(frame(spark, [(k, f"p{k % 60}") for k in range(240)]), name, F.col("v") >= 0)
        assert len(asked) <= 3 and sum("VIEW" in t for t in asked) == 1
    assert spark.table(name).count() == 240


def test_old_versions_go_and_a_reader_of_the_last_one_ends(spark, name):
    sk.overwrite(frame(spark, [(1, "a"), (2, "b")]), name, ["p"])
    reader = spark.table(name)
    sk.replace_window(frame(spark, [(3, "a")]), name, F.col("p") == "a")
    assert sorted(r["v"] for r in reader.collect()) == [1, 2]
    for k in range(4, 8):
        sk.replace_window(frame(spark, [(k, "a")]), name, F.col("p") == "a")
    data = vs.pointer(spark, name).data
    there = spark.sql(f"SHOW PARTITIONS {data}").collect()
    assert len(there) == 3 and held(spark, name) == [(2, "b"), (7, "a")]
    database = name.split(".")[0]
    assert len([t for t in spark.catalog.listTables(database)]) <= 4


def test_vacuum_removes_what_a_stopped_run_left(spark, name, monkeypatch):
    sk.overwrite(frame(spark, [(1, "a")]), name, ["p"])
    monkeypatch.setattr(vs, "point", lambda *a: 1 / 0)
    for change in (CHANGES["append"], CHANGES["overwrite"]):
        with pytest.raises(ZeroDivisionError):
            change(spark, name)
    monkeypatch.undo()
    assert held(spark, name) == [(1, "a")]
    assert len(vs.vacuum(spark, name)) == 3  # a data table, a manifest, a version
    assert held(spark, name) == [(1, "a")] and vs.vacuum(spark, name) == []


def test_append_refuses_or_adds_columns(spark, name, rows):
    sk.append(spark.createDataFrame([(1, "a")], "k int, p string"), name, ["p"])
    more = spark.createDataFrame([(2, "b", 2.5)], "k int, p string, x double")
    with pytest.raises(ValueError, match="x"):
        sk.append(more, name)
    with pytest.raises(ValueError, match="k"):
        sk.append(more.select("p"), name)
    sk.append(more, name, widen=True)
    sk.append(spark.createDataFrame([("c",)], "p string"), name, widen=True)
    assert rows(spark.table(name), "k", "x", "p") == sorted([(1, None, "a"), (2, 2.5, "b"), (None, None, "c")], key=str)
    assert spark.table(name).columns == ["k", "x", "p"]


def test_types_widen_without_a_rewrite(spark, name):
    sk.append(spark.createDataFrame([(1, 1.5, "a")], "k int, f float, p string"), name, ["p"])
    big = 1 << 40
    sk.append(spark.createDataFrame([(big, 0.1, "a")], "k bigint, f double, p string"), name, widen=True)
    sk.append(spark.createDataFrame([(3, 2.5, "b")], "k int, f float, p string"), name, widen=True)
    got = spark.table(name)
    assert dict(got.dtypes) == {"k": "bigint", "f": "double", "p": "string"}
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1.5, "a"), (3, 2.5, "b"), (big, 0.1, "a")]
    sk.replace_window(spark.createDataFrame([(4, 1.0, "a")], "k int, f float, p string"), name, F.col("k") == 1, widen=True)
    assert sorted(r["k"] for r in spark.table(name).collect()) == [3, 4, big]
    with pytest.raises(ValueError, match="does not go with"):
        sk.append(spark.createDataFrame([("x", 1.0, "a")], "k string, f double, p string"), name, widen=True)
    other = f"{name}2"
    sk.append(spark.createDataFrame([(1, 2)], "v int, p int"), other, ["p"])
    with pytest.raises(ValueError, match="partition column"):
        sk.append(spark.createDataFrame([(1, 2)], "v int, p bigint"), other, widen=True)


def test_backfill_keeps_a_new_column(spark, name):
    old = spark.createDataFrame([(d, date(2024, 1, d)) for d in range(1, 6)], "v int, day date")
    sk.overwrite(old, name, ["day"])
    landed = work_dir(spark, "landed")
    broken = F.col("day").between(F.lit(date(2024, 1, 2)), F.lit(date(2024, 1, 3)))
    old.where(broken).withColumn("note", F.concat(F.lit("n"), "v")).write.json(landed)
    schema = spark.createDataFrame([], "v int, day date, note string").schema
    ss.backfill(spark, landed, name, broken, schema, widen=True)
    got = sorted((r["v"], r["day"].day, r["note"]) for r in spark.table(name).collect())
    assert got == [(1, 1, None), (2, 2, "n2"), (3, 3, "n3"), (4, 4, None), (5, 5, None)]


def test_stream_of_a_versioned_table(spark, name):
    sk.overwrite(frame(spark, [(1, "a"), (2, "b")]), name, ["p"])
    sk.replace_window(frame(spark, [(3, "a")]), name, F.col("p") == "a")
    out, checkpoint = work_dir(spark, "out"), work_dir(spark, "checkpoint")
    read = lambda: sorted(r["v"] for r in spark.read.parquet(out).collect())
    ss.run_available(rd.stream_table(spark, name), out, checkpoint)
    assert read() == [2, 3]
    sk.append(frame(spark, [(4, "c")]), name)
    ss.run_available(rd.stream_table(spark, name), out, checkpoint)
    assert read() == [2, 3, 4]


def test_feature_vectors_keep_their_type(spark, name):
    from pyspark.ml.feature import VectorAssembler

    df = VectorAssembler(inputCols=["a"], outputCol="x").transform(spark.createDataFrame([(1.0,), (2.0,)], "a double"))
    for _ in range(3):
        sk.save_features(df, name)
    assert spark.table(name).schema["x"].dataType == df.schema["x"].dataType
    assert sorted(r["x"][0] for r in spark.table(name).collect()) == [1.0, 2.0]


def test_a_table_of_someone_else_and_its_removal(spark, name, rows):
    spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string").write.partitionBy("p").saveAsTable(name)
    sk.replace_window(frame(spark, [(3, "b")]), name, F.col("p") == "b")
    assert held(spark, name) == [(1, "a"), (3, "b")] and sk.partition_columns(spark, name) == ["p"]
    vs.remove(spark, name)
    assert not spark.catalog.tableExists(name)
    assert [t for t in spark.catalog.listTables(name.split(".")[0]) if not t.isTemporary] == []
