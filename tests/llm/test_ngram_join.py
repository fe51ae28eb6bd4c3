import random

import numpy as np
import pyarrow as pa
import pytest

from adflow.llm import ngram_join as nj
from adflow.llm.components import components

from .conftest import words


def brute(rows, size=5):
    """Set sizes and components by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(max(len(w) - size, 0) + 1)} if w else set())
    parent = {k: k for k, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                same = len(sets[i] & sets[j])
                if 100 * same >= 75 * (len(sets[i]) + len(sets[j]) - same):
                    a, b = sorted((find(rows[i][0]), find(rows[j][0])))
                    parent[b] = a
    return sorted((k, len(s), find(k)) for (k, _), s in zip(rows, sets))


def corpus(rng, n=240):
    """Random texts, near copies around the threshold, a big loose group, shared passages."""
    passage = words(rng, 60)
    rows = []
    base = words(rng, 120)
    for k in range(n):
        kind = k % 6
        if kind == 0:
            text = words(rng, rng.randrange(1, 80))
        elif kind in (1, 2):  # edits of one text: some pairs link, some do not
            text = list(base)
            for _ in range(rng.randrange(0, 9)):
                text[rng.randrange(len(text))] = f"edit{rng.randrange(10**6)}"
        elif kind == 3:  # a common passage and own words
            text = passage + words(rng, rng.randrange(5, 60))
        elif kind == 4 and len(rows) > 12:
            text = rng.choice(rows)[1].split()
            for _ in range(rng.randrange(0, 3)):
                text[rng.randrange(len(text))] = "x"
        else:
            text = passage[:rng.randrange(1, 60)]
        rows.append((k, " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_brute_force(spark, make_docs, rows, seed, monkeypatch):
    # Small blocks, shards and chunks, so that all of the exchange is used.
    monkeypatch.setattr(nj, "SHARD_CHARS", 4000)
    monkeypatch.setattr(nj, "BLOCK_SHINGLES", 600)
    monkeypatch.setattr(nj, "CHUNK", 8)
    data = corpus(random.Random(seed))
    got = rows(nj.near_duplicates(make_docs(data, parts=5)), "doc_id", "n_shingles", "component_id")
    assert sorted(got) == brute(data)


def test_threshold_is_inclusive(make_docs, rows):
    # 7 shingles and 7 shingles, 6 shared: 6 / 8 is exactly 75 percent.
    a = "a b c d e f g h i j k"
    data = [(1, a), (2, a.replace("a ", "z ", 1)), (3, "a b c d e f g h"), (4, "q a b c d e f g h")]
    got = {r[0]: r[2] for r in rows(nj.near_duplicates(make_docs(data)), "doc_id", "n_shingles", "component_id")}
    assert got == {k: c for k, _, c in brute(data)}
    assert got[2] == 1


def test_odd_rows(make_docs, odd_rows):
    got = nj.near_duplicates(make_docs(odd_rows)).collect()
    by = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}
    assert len(got) == len(odd_rows)
    assert by[1] == (0, 1) and by[2] == (0, 2) and by[3] == (0, 3) and by[4] == (1, 4)
    assert by[5][1] == by[6][1] == 5 and by[None][1] is None and by[8][1] == 8


def test_copies_behind_a_row_without_a_key(spark, rng):
    base = words(rng, 60)
    text, near = " ".join(base), " ".join([*base[:-1], "other"])
    data = [(None, text), (4, text), (5, text), (None, text), (6, near), (7, " ".join(words(rng, 60)))]
    df = spark.createDataFrame(data, "doc_id bigint, text string").coalesce(1)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in nj.near_duplicates(df).collect()]
    assert sorted(r for r in got if r[0] is not None) == [(4, 56, 4), (5, 56, 4), (6, 56, 4), (7, 56, 7)]
    assert [r for r in got if r[0] is None] == [(None, 56, None)] * 2


def test_empty_table_and_clashing_names(spark, make_docs):
    assert nj.near_duplicates(make_docs([])).count() == 0
    df = make_docs([(1, "a b c"), (2, "a b c")]).selectExpr("*", "1 AS k", "2 AS n", "'x' AS prefix", "3 AS component")
    assert {r["component_id"] for r in nj.near_duplicates(df).collect()} == {1}


def test_packed_shingles_round_trip():
    fp = np.sort(np.random.default_rng(0).integers(0, 1 << 40, 500).astype(np.uint64))
    text, count = np.arange(500) % 77, np.arange(500) + 1
    a, b, c = nj.unpack(nj.pack(fp, text, count))
    assert (a == fp).all() and (b == text).all() and (c == count).all()
    assert len(nj.unpack(nj.pack(fp[:0], text[:0], count[:0]))[0]) == 0


def test_components_of_a_path_and_a_star(spark, rows):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (None, 3)]
    got = dict(rows(components(spark.createDataFrame(edges, "x bigint, y bigint")), "vertex", "component"))
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}}
    assert components(spark.createDataFrame([], "x bigint, y bigint")).count() == 0


def test_shingle_sets_of_short_texts():
    sets = nj.shingle_sets(pa.array(["a b", "A B", "b a", "", None, "a b c d e", "a b c d e f"]))
    assert [len(s) for s in sets] == [1, 1, 1, 0, 0, 1, 2]
    assert sets[0] == sets[1] and sets[0] != sets[2] and sets[5][0] in sets[6]


@pytest.mark.parametrize("kind", ["string", "int", "decimal(12,1)", "date"])
def test_key_types(spark, rng, kind):
    """The same groups whatever the type of the key, by its own order."""
    base = [words(rng, 60) for _ in range(3)]
    texts = [" ".join(base[k % 3][:-1] + [f"end{k}"]) if k % 2 else " ".join(base[k % 3]) for k in range(12)]
    key = {"date": "date_add(DATE'2024-01-01', n)", "string": "concat('doc ', lpad(CAST(n AS STRING), 3, '0'))"}.get(
        kind, f"CAST(n AS {kind})")
    docs = spark.createDataFrame(list(enumerate(texts)), "n int, text string").selectExpr("n", f"{key} AS doc_id", "text")
    name = {r["doc_id"]: r["n"] for r in docs.collect()}
    got = {name[r["doc_id"]]: name[r["component_id"]] for r in nj.near_duplicates(docs.drop("n")).collect()}
    assert got == {k: k % 3 for k in range(12)}
