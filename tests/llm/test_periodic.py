import random

import numpy as np
import pytest

from adflow.llm import periodic as pe
from adflow.llm.grammar import repair, runs

from .conftest import words


def brute(w, least=12):
    """Every run as (start, length, smallest period), by trying all periods."""
    n, out = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in out.items())


def collapsed(w):
    gone = {k for s, n, q in brute(w) for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def text(rng):
    n = rng.randrange(0, 150)
    w = [f"w{rng.randrange(rng.choice([1, 2, 3, 5, 50]))}" for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + rng.randrange(max((n - a) // 3, 1))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def numbered(texts):
    """Symbols that differ between texts, and where each text starts."""
    ids = {}
    flat = [ids.setdefault((k, x), len(ids)) for k, w in enumerate(texts) for x in w]
    return np.array(flat, np.int64), np.cumsum([0] + [len(w) for w in texts])


def test_runs_against_brute_force(rng):
    for _ in range(150):
        texts = [text(rng) for _ in range(rng.randrange(1, 6))]
        symbols, first = numbered(texts)
        if not len(symbols):
            continue
        got = [tuple(map(int, r)) for r in zip(*runs(symbols, first))]
        assert got == [(s + int(first[k]), n, q) for k, w in enumerate(texts) for s, n, q in brute(w)]


@pytest.mark.parametrize("w", [
    "ab" * 40, "a" * 64, "aab" * 9 + "c" + "aab" * 9, "abcab" * 5 + "abc", "a" * 11, "a" * 12, "abcdef" * 2,
    "abaababaabaababaababaabaababaabaab",  # a Fibonacci word: runs with many periods
])
def test_known_stretches(w):
    symbols, first = numbered([list(w)])
    assert [tuple(map(int, r)) for r in zip(*runs(symbols, first))] == brute(list(w))


def test_grammar_derives_the_text(rng):
    """Every rule's halves and every place of it hold the same words; repeated pairs are rules."""
    texts = [text(rng) for _ in range(8)]
    symbols, first = numbered(texts)
    rules = repair(symbols, first)
    assert ((rules.left > 0) & (rules.left < rules.size)).all()
    for x, place in zip(rules.of.tolist(), rules.places.tolist()):
        n = rules.size[x]
        assert (symbols[place:place + n] == symbols[rules.at[x]:rules.at[x] + n]).all()
    # A text of one word: its rules double, so there are few of them.
    many, one = numbered([["x"] * 4096])
    assert len(repair(many, one).at) == 12


def check(df, docs):
    want = sorted((k, len(w), brute(w), collapsed(w)) for k, w in docs)
    got = sorted((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"])
                 for r in pe.periodic_runs(df).collect())
    assert got == want


def test_operator_against_brute_force(make_docs, rng):
    docs = [(k, text(rng)) for k in range(80)]
    check(make_docs([(k, " \n".join(w)) for k, w in docs], 3), docs)


def test_odd_rows(make_docs, odd_rows):
    got = pe.periodic_runs(make_docs(odd_rows + [(20, "x " * 50_000)]))
    by = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == len(odd_rows) + 1
    for k in (1, 2, 3):
        assert (by[k]["n_words"], by[k]["runs"], by[k]["collapsed"]) == (0, [], "")
    assert by[5]["runs"] == [] and by[5]["n_words"] == 30_000
    assert [tuple(x) for x in by[20]["runs"]] == [(0, 50_000, 1)] and by[20]["collapsed"] == "x"
    assert [tuple(x) for x in by[None]["runs"]] == [(0, 100, 5)]
    assert by[8]["collapsed"] == "same text here"


def test_empty_table_and_clashing_names(make_docs, spark):
    assert pe.periodic_runs(make_docs([])).collect() == []
    df = spark.createDataFrame([("k1", "a b " * 10, 1, 2, 3)], "row string, t string, runs int, n_words int, k int")
    assert [(r["row"], len(r["runs"])) for r in pe.periodic_runs(df, "row", "t").collect()] == [("k1", 1)]


def test_long_text_of_few_words(make_docs):
    rng = random.Random(9)
    w = words(rng, 3000, 3)
    check(make_docs([(1, " ".join(w))]), [(1, w)])
