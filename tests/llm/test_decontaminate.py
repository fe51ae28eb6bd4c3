import hashlib
import random
import re

import numpy as np
import pytest

from adflow.llm import decontaminate as dc
from adflow.llm.fm_index import FMIndex

from .conftest import words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items, window=10):
    phrases = {}
    for item, text in items:
        w = WORD.findall((text or "").lower())
        for k in range(max(len(w) - window, 0) + 1 if w else 0):
            phrases.setdefault(tuple(w[k:k + window]), set()).add(str(item))
    out = []
    for key, text in docs:
        w = WORD.findall((text or "").lower())
        hit, found = set(), set()
        for size in {len(p) for p in phrases}:
            for k in range(len(w) - size + 1):
                own = phrases.get(tuple(w[k:k + size]))
                if own:
                    hit |= set(range(k, k + size))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(found), digest, bool(hit)))
    return out


@pytest.fixture()
def bench(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id bigint, text string")


def cases(rng):
    items = [(k, " ".join(words(rng, rng.randrange(1, 30), 60))) for k in range(25)] + [
        (25, "short one"), (26, None), (27, ""), (28, "..."), (3, "another text of item three")]
    docs = []
    for k in range(120):
        text = words(rng, rng.randrange(0, 120), 90)
        for _ in range(rng.randrange(0, 3)):
            w = (rng.choice(items)[1] or "").split()
            at, cut = rng.randrange(len(text) + 1), rng.randrange(0, 4)
            text[at:at] = w[cut:]
        docs.append((k, rng.choice([" ", ", ", "\n"]).join(text).title()))
    return docs, items


@pytest.mark.parametrize("block", [dc.BLOCK_BYTES, 200])
@pytest.mark.parametrize("shard", [dc.SHARD_SYMBOLS, 50])
def test_equals_brute_force(make_docs, bench, rows, monkeypatch, block, shard):
    monkeypatch.setattr(dc, "SHARD_SYMBOLS", shard)
    docs, items = cases(random.Random(9))
    got = rows(dc.contamination(make_docs(docs), bench(items), block_bytes=block))
    assert sorted(got) == sorted(brute(docs, items))
    assert any(r[5] for r in got) and not all(r[5] for r in got)


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(4)
    for n, letters in ((1, 2), (40, 2), (500, 3), (800, 40)):
        text = rng.integers(1, letters + 1, n)
        index = FMIndex(text)
        phrases = [text[i:i + k] for i in range(0, n, 7) for k in (1, 2, 5)] + [np.array([letters + 9])]
        padded = np.zeros((len(phrases), 5), np.int64)
        sizes = np.array([len(p) for p in phrases])
        for k, p in enumerate(phrases):
            padded[k, :len(p)] = p
        lo, hi = index.search(padded, sizes)
        for k, p in enumerate(phrases):
            want = [i for i in range(n - len(p) + 1) if (text[i:i + len(p)] == p).all()]
            assert sorted(index.locate(np.arange(lo[k], hi[k])).tolist()) == want


def test_odd_rows_and_clashing_names(make_docs, bench, odd_rows):
    items = [(1, "same text here same text here same text here same"), (None, "word")]
    df = make_docs(odd_rows).selectExpr("*", "1 AS hits", "2 AS items", "3 AS n_words", "'x' AS __text2")
    got = {r["doc_id"]: r for r in dc.contamination(df, bench(items)).collect()}
    assert got[1]["n_words"] == 0 and not got[1]["contaminated"]
    assert got[4]["n_hit"] == 1 and got[4]["items_sha256"] == hashlib.sha256(b"").hexdigest()
    # The phrase fits at every third word, the last time at word 78.
    assert (got[8]["n_hit"], got[8]["n_words"]) == (88, 90)
    assert dc.contamination(make_docs([]), bench(items)).count() == 0
    assert dc.contamination(make_docs(odd_rows), bench([])).where("contaminated").count() == 0
    cut = dc.cut(df, bench(items))
    assert cut.columns == df.columns and cut.count() == len(odd_rows)


def test_cut_removes_passages_and_keeps_the_rest(make_docs, bench):
    passage = " ".join(f"p{k}" for k in range(12))
    docs = [(1, f"É start {passage}. end"), (2, "nothing of it"), (3, None), (4, passage),
            (5, f"a {passage} b {passage.upper()} c")]
    got = {r["doc_id"]: r["text"] for r in dc.cut(make_docs(docs), bench([(1, passage)])).collect()}
    assert got == {1: "É start . end", 2: "nothing of it", 3: None, 4: "", 5: "a  b  c"}


def test_long_items_are_cut_without_losing_a_window():
    rng = random.Random(5)
    for n in (0, 1, 9, 10, 11, 300):
        text = " ".join(words(rng, n, 50)) + "."
        for most in (1, 30, 200, 10_000):
            pieces = list(dc._pieces(text, 10, most))
            got = {p for piece in pieces for p in _windows(piece)}
            assert got == set(_windows(text))
            assert all(len(p) <= max(most, len(text) if n < 11 else 200) for p in pieces)


def _windows(text):
    w = WORD.findall(text.lower())
    return [tuple(w[k:k + 10]) for k in range(max(len(w) - 9, 1) if w else 0)]


def test_blocks_are_bounded_and_whole(bench):
    rng = random.Random(6)
    items = [(k, " ".join(words(rng, rng.randrange(0, 90), 40))) for k in range(40)] + [
        (40, " ".join(words(rng, 2000, 40))), (None, "a b"), (1, None)]
    got = list(dc.blocks(bench(items + items), 10, 500, "item_id", "text"))
    want = {(w, str(i if i is not None else "")) for i, t in items for w in _windows(t or "")}
    found = set()
    for p in got:
        assert len(p.lengths) <= 500
        found |= {(tuple(p.vocabulary[s[:n] - 2].tolist()), i)
                  for s, n, own in zip(p.symbols, p.lengths, p.items) for i in own}
    assert len(got) > 20 and len(found) == len(want)
