"""The stages against what their operators say, on planted documents and on a whole table."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from adflow.llm import decontaminate, host_rules, ngram_join, toxicity
from adflow.llm.stage import staged

from .conftest import words

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage's result over the whole table, each on all that the last kept."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        docs = staged(stage(spark, docs, SF), "pipeline-test")
        out.append(docs)
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_names_and_columns(spark, stages):
    assert [n for n, _ in cp.STAGES] == [
        "toxicity", "quality rules", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    for out in stages[:-1]:
        assert out.columns == documents.columns and out.dtypes == documents.dtypes


def test_decisions_take_effect(spark, stages):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    toxic = toxicity.score(documents, toxicity.train(documents, labels), ["doc_id"])
    assert ids(stages[0]) == ids(toxic.where("predicted = 0"))
    assert ids(stages[1]) == ids(host_rules.judge(stages[0]).where("kept"))
    groups = ngram_join.near_duplicates(stages[1])
    assert ids(stages[2]) == {r["component_id"] for r in groups.collect()}
    assert stages[2].count() == groups.select("component_id").distinct().count()
    assert ids(stages[3]) == ids(stages[2])
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    before = decontaminate.contamination(stages[2], bench).where("contaminated")
    assert before.count() > 0
    text = stages[2].select("doc_id", F.col("text").alias("old")).join(stages[3], "doc_id")
    changed = text.where("old <> text")
    assert ids(changed) == ids(before)
    assert text.where("n_chars <> length(text)").count() == 0
    assert ids(stages[4]) == ids(stages[3])


def test_clean_documents_stay(spark, make_docs):
    rng = random.Random(4)
    text = lambda: " ".join(words(rng, 90, 5000))
    passage = " ".join(f"bench{k}" for k in range(15))
    base = text()
    rows = [(k, text()) for k in range(60)]
    rows += [(100, base), (101, base), (102, base + " one more"), (200, "too short"), (201, f"{text()} {passage} {text()}"), (None, text())]
    docs = make_docs(rows)
    kept = cp.quality_rules(spark, docs, SF)
    assert ids(kept) == {r[0] for r in rows} - {200}
    single = cp.near_duplicates(spark, kept, SF)
    assert ids(single) == {r[0] for r in rows} - {200, 101, 102}
    bench = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    cut = {r["doc_id"]: r["text"] for r in decontaminate.cut(single, bench).collect()}
    assert "bench" not in cut[201] and len(cut[201].split()) == 180
    assert all(cut[k] == t for k, t in rows if k in cut and k != 201)


def test_repeated_rows_are_one_document(spark, make_docs):
    rng = random.Random(6)
    one, two = " ".join(words(rng, 60)), " ".join(words(rng, 60))
    rows = [(5, one), (5, one), (9, one), (7, two), (7, two + " and more"), (None, one), (None, one), (None, None)]
    kept = cp.near_duplicates(spark, make_docs(rows).withColumn("n", F.lit(1)), SF).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(
        [(5, one), (7, two), (None, one), (None, one), (None, None)], key=str)


def test_odd_rows_go_through(spark, make_docs, odd_rows):
    # Without a host, so that the short ones do not take the long ones with them.
    docs = make_docs(odd_rows).withColumn("source", F.lit(None).cast("string")).withColumn("score", F.lit(1)).withColumn("row", F.lit(2)).withColumn("k", F.lit(3))
    for name, stage in cp.STAGES:
        out = staged(stage(spark, docs, SF), "odd")
        if stage is not cp.packed:
            assert out.columns == docs.columns
            docs = out
    assert out.count() > 0


def test_empty_table(spark, make_docs):
    docs = make_docs([])
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF) if stage is cp.packed else staged(stage(spark, docs, SF), "empty")
    assert docs.count() == 0
