import random

import numpy as np
import pytest

from adflow.llm import substring_dedup as sd
from adflow.llm.run_index import RangeMin, RunIndex

from .conftest import words


def brute(docs, least=13):
    """(key, n_words, removed words, kept text) per row."""
    first = {}
    split = [(k, (t or "").replace("\x0b", " ").replace("\x0c", " ")) for k, t in docs]
    split = [(k, [w for w in t.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w])
             for k, t in split]
    for k, w in split:
        for i in range(len(w) - least + 1) if k is not None else ():
            window = tuple(w[i:i + least])
            first[window] = min(first.get(window, k), k)
    out = []
    for k, w in split:
        gone = set()
        for i in range(len(w) - least + 1) if k is not None else ():
            if first[tuple(w[i:i + least])] < k:
                gone |= set(range(i, i + least))
        out.append((k, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def corpus(rng, n=150):
    passages = [words(rng, rng.randrange(5, 60), 300) for _ in range(12)]
    docs = []
    for k in range(n):
        text = words(rng, rng.randrange(0, 80), 300)
        for _ in range(rng.randrange(0, 4)):
            own, at = rng.choice(passages), rng.randrange(len(text) + 1)
            lo = rng.randrange(len(own))
            text[at:at] = own[lo:] if rng.random() < 0.5 else own
        if docs and rng.random() < 0.2:
            text = rng.choice(docs)[1].split()
            if text and rng.random() < 0.5:
                text[rng.randrange(len(text))] = "changed"
        docs.append((rng.randrange(1000, 9999), " ".join(text)))
    return docs


def collected(df, key="doc_id"):
    return sorted(((r[key], r["n_words"], sum(s["words"] for s in r["removed"]), r["kept"])
                   for r in df.collect()), key=str)


@pytest.mark.parametrize("hot", [1, 4096])
def test_against_brute_force(make_docs, rng, hot):
    docs = corpus(rng)
    got = sd.repeated_passages(make_docs(docs, 3), block_bytes=4000, shard_bytes=9000, hot=hot)
    assert collected(got) == sorted(brute(docs), key=str)


def test_odd_rows(make_docs, odd_rows):
    got = sd.repeated_passages(make_docs(odd_rows))
    assert collected(got) == sorted(brute(odd_rows), key=str)
    by = {(r["doc_id"], r["n_words"]): r for r in got.collect()}
    # The long text twice: the later one goes whole. Rows of one key take nothing from each other.
    assert [tuple(s) for s in by[6, 30_000]["removed"]] == [(0, 30_000)] and by[6, 30_000]["kept"] == ""
    assert by[8, 90]["removed"] == [] and by[None, 100]["removed"] == []


def test_empty_table(make_docs):
    assert sd.repeated_passages(make_docs([])).collect() == []


@pytest.mark.parametrize("kind", ["string", "int", "decimal(20,2)", "date"])
def test_key_types_and_clashing_names(spark, kind):
    text = " ".join(words(random.Random(1), 40))
    rows = spark.createDataFrame([(k, text) for k in range(1, 4)], "n int, t string")
    key = {"date": "date_add(DATE'2024-01-01', n)"}.get(kind, f"CAST(n AS {kind})")
    df = rows.selectExpr(f"{key} AS k", "t", "1 AS block", "2 AS payload", "3 AS shared", "4 AS words")
    got = {r["k"]: r for r in sd.repeated_passages(df, "k", "t").collect()}
    assert sorted(len(r["removed"]) for r in got.values()) == [0, 1, 1]
    assert got[min(got)]["removed"] == [] and got[min(got)]["n_words"] == 40


def test_windows_are_judged_on_the_input(make_docs, rng):
    """A passage that goes from the second text still counts against the third."""
    own = words(rng, 20)
    docs = [(k, " ".join(words(rng, 5) + own + words(rng, 5))) for k in (3, 2, 1)]
    got = {r["doc_id"]: r for r in sd.repeated_passages(make_docs(docs)).collect()}
    assert [[tuple(s) for s in got[k]["removed"]] for k in (1, 2, 3)] == [[], [(5, 20)], [(5, 20)]]


def test_range_min(rng):
    values = np.array([rng.randrange(100) for _ in range(700)], np.int32)
    lo = np.array([rng.randrange(700) for _ in range(2000)])
    hi = np.array([rng.randrange(a + 1, 701) for a in lo])
    assert RangeMin(values).least(lo, hi).tolist() == [values[a:b].min() for a, b in zip(lo, hi)]


def test_matching_statistics_against_brute_force(rng):
    for _ in range(60):
        pieces = [[rng.randrange(1, 4) for _ in range(rng.randrange(0, 14))] for _ in range(rng.randrange(1, 20))]
        owner, cut = np.array([rng.randrange(6) for _ in pieces]), np.cumsum([0] + [len(p) for p in pieces])
        symbols = np.array([x for p in pieces for x in p], np.int64)
        if not len(symbols):
            continue
        piece, a, b = RunIndex(symbols, cut, owner).matches(symbols, cut, owner, 4)
        got = {(int(k), i) for k, x, y in zip(piece, a, b) for i in range(x, y - 3)}
        have = {}
        for p, o in zip(pieces, owner):
            for i in range(len(p) - 3):
                have[tuple(p[i:i + 4])] = min(have.get(tuple(p[i:i + 4]), 99), int(o))
        assert got == {(k, i) for k, p in enumerate(pieces) for i in range(len(p) - 3)
                       if have[tuple(p[i:i + 4])] < owner[k]}
