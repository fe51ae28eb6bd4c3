"""Toxicity, quality and language: held-out accuracy, and what they do with odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from adflow.llm import language as lg
from adflow.llm import quality as ql
from adflow.llm import toxicity as tx

from .conftest import words

SF = "/root/testdata/sf0.1"
LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")}


def auc(score, label):
    order = np.argsort(np.argsort(score))
    up = label == 1
    return (order[up].mean() - (up.sum() - 1) / 2) / (~up).sum()


@pytest.mark.parametrize("name,parts,rest,least", [("toxic", 5, 0, 0.97), ("quality", 3, 1, 0.97)])
def test_held_out_accuracy(tables, name, parts, rest, least):
    run = tx.toxicity if name == "toxic" else ql.quality
    got = run(tables["documents"], tables["labels"]).join(tables["labels"], "doc_id").toPandas()
    for doc, apart in zip(got["doc_id"].head(200), got["held_out"].head(200)):
        assert apart == (zlib.crc32(str(doc).encode()) % parts == rest)
    assert got["score"].between(0, 1).all()
    assert ((got["score"] >= 0.5) == (got["predicted"] == 1)).all()
    own = got[got["held_out"]]
    assert auc(own["score"].to_numpy(), own[name].to_numpy()) > least
    assert (own["predicted"] == own[name]).mean() > least


def test_a_capped_sample_scores_like_all_labels(tables):
    """500 of each class: without the shift the odds of every document are 5.6 times too high."""
    docs, labels = tables["documents"], tables["labels"]
    assert tx.sample_shift(labels, "toxic", tx.SAMPLE, 5, 0) == 0 > -1.6 > tx.sample_shift(labels, "toxic", 500, 5, 0)
    own = docs.join(labels.select("doc_id").distinct(), "doc_id")
    full, capped = (tx.score(own, tx.train(docs, labels, most=most), ["doc_id"]).toPandas().set_index("doc_id")["predicted"]
                    for most in (tx.SAMPLE, 500))
    assert (full == capped.loc[full.index]).mean() > 0.99
    assert abs(full.mean() - capped.mean()) < 0.01


def test_languages_of_held_out_documents(tables):
    docs = tables["documents"]
    got = lg.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    own = got[got["held_out"]]
    assert (own["lang_pred"] == own["lang"]).mean() > 0.99
    assert got["score"].between(0, 1).all()


def test_families_then_languages_within():
    rng = random.Random(1)
    alphabets = {"en": "abcdefth", "de": "abcdefch", "fr": "oupqrst", "es": "oupqrsñ", "zz": "kkkjjx"}
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(30))
    texts = [(lang, make(a)) for lang, a in alphabets.items() for _ in range(30)]
    x = lg.vectors(pa.array([t for _, t in texts]))
    model = lg.fit(x, np.array([lang for lang, _ in texts], object))
    assert model.families.names == ["germanic", "romance", "zz"]
    assert model.within["romance"].names == ["es", "fr"] and model.within["zz"].names == ["zz"]
    fresh = [(lang, make(a)) for lang, a in alphabets.items() for _ in range(10)]
    got, score = model.predict(pa.array([t for _, t in fresh]))
    assert (got == np.array([lang for lang, _ in fresh], object)).mean() > 0.95
    assert ((score > 0) & (score <= 1)).all()
    odd, score = model.predict(pa.array([None, "", "123 !?", "é", "日本"]))
    assert odd[:3].tolist() == ["und"] * 3 and (score[:3] == 0).all() and "und" not in odd[3:]


def test_odd_rows_and_clashing_names(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows).selectExpr("*", "1 AS key", "2 AS label", "3 AS score", "'x' AS name", "4 AS predicted")
    labels = spark.createDataFrame(
        [(4, 1, 0), (8, 0, 1), (8, 0, 0), (10, 1, 0), (None, 1, 1), (5, None, None), (7, 1, 0)], LABELS)
    for run in (tx.toxicity, ql.quality):
        got = run(docs, labels).collect()
        assert len(got) == len(odd_rows)
        assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    assert lg.languages(docs).count() == len(odd_rows)


def test_nothing_to_learn_from(spark, make_docs, odd_rows):
    labels = spark.createDataFrame([], LABELS)
    for run in (tx.toxicity, ql.quality):
        assert run(make_docs(odd_rows), labels).where("predicted = 0").count() == len(odd_rows)
        assert run(make_docs([]), labels).count() == 0
    assert lg.languages(make_docs([])).count() == 0
    bare = make_docs([(1, "some text", None), (2, None, None)])
    assert {r["lang_pred"] for r in lg.languages(bare).collect()} == {"und"}


def test_sparse_weights_and_rates():
    rng = random.Random(2)
    texts, labels = [], []
    for k in range(600):
        w = words(rng, 40, 500)
        if k % 3 == 0:
            w[rng.randrange(40)] = "rude"
        texts.append(" ".join(w))
        labels.append(1.0 if k % 3 == 0 else 0.0)
    examples = [np.unique(tx.features(tx._words(pa.array([t])))[1]) for t in texts]
    model = tx.fit(examples, np.array(labels))
    assert 0 < len(model.places) < 400 < sum(map(len, examples)) / 100
    got = model.scores(pa.array([" ".join(words(rng, 40, 500)) + " RUDE!", " ".join(words(rng, 40, 500)), "", None]))
    assert got[0] > 0.5 > max(got[1:]) and got[2] == got[3]


def test_word_vectors_do_not_depend_on_the_tree(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(k, " ".join(words(rng, 50, 60))) for k in range(40)]
    one = ql.word_vectors(spark.createDataFrame(rows, "doc_id int, text string").coalesce(1))
    monkeypatch.setattr(ql, "FAN", 2)
    many = ql.word_vectors(spark.createDataFrame(rows, "doc_id int, text string").repartition(7))
    assert np.allclose(one, many, atol=1e-6)


def test_context_vectors_by_hand():
    texts = pa.array(["a b c d", None, "b a"])
    want = np.zeros(ql.WORDS * ql.WIDTH)
    for text in ("a b c d", "b a"):
        w = ql.Texts.of(pa.array([text])).words().hashes()
        for i in range(len(w)):
            for j in range(len(w)):
                if 0 < abs(i - j) <= ql.REACH:
                    for k in range(ql.NONZERO):
                        place, sign = ql._index(w[j:j + 1], k)
                        want[int(w[i] & np.uint64(ql.WORDS - 1)) * ql.WIDTH + place[0]] += sign[0]
    assert (ql.contexts(texts) == want).all()
