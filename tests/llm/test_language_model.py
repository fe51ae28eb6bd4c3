import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from adflow.llm import language_model as lm
from adflow.llm import ngram_trie as nt

from .conftest import words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + ["</s>"]


def apart(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


def brute(rows, weights):
    """Every figure by dictionaries; ``weights`` per class of contexts."""
    count, pairs = Counter(), Counter()
    for key, text in rows:
        if not apart(key):
            w = tokens(text)
            count.update(w)
            pairs.update(zip(["<s>", *w], w))
    total, known = sum(count.values()), len(count)
    head = {**count, "<s>": count["</s>"]}
    out = []
    for key, text in rows:
        w = tokens(text)
        base = [math.log10((count[x] + 1) / (total + known + 1)) for x in w]
        score = 0.0
        for h, x, b in zip(["<s>", *w], w, base):
            c = head.get(h, 0)
            own = weights[int(math.log2(c)) + 1] if c else 0.0
            p = (1 - own) * 10 ** b + (own * pairs[(h, x)] / c if c else 0)
            score += math.log10(p)
        out.append((key, apart(key), len(w), sum(count[x] > 0 for x in w), total, sum(base), score))
    return out


def corpus(rng, n=150):
    rows = []
    for k in range(n):
        w = words(rng, rng.randrange(0, 60), 40)
        if k % 3 == 0:
            w += "a phrase that many texts have in common".split()
        rows.append((k, rng.choice([" ", "\n"]).join(w).title()))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_scores_equal_brute_force(make_docs, monkeypatch, small):
    if small:
        monkeypatch.setattr(lm, "SHARD_CHARS", 1500)
        monkeypatch.setattr(lm, "BLOCK_TOKENS", 300)
    seen = {}
    fit = lm.mixture
    monkeypatch.setattr(lm, "mixture", lambda *a: seen.setdefault("weights", fit(*a)))
    rows = corpus(random.Random(6)) + [(None, "a phrase that"), (500, None), (500, ""), (501, "unseen\x1cword")]
    got = sorted((tuple(r) for r in lm.score(make_docs(rows, 5)).collect()), key=lambda r: (str(r[0]), r[2]))
    want = sorted(brute(rows, seen["weights"]), key=lambda r: (str(r[0]), r[2]))
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9)
        assert a[6] == pytest.approx(b[6], rel=0.02)  # ratios are quantised
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_probabilities_of_a_context_add_up_to_one():
    count = Counter({"a": 5, "b": 3, "</s>": 2})
    total, known = 10, 3
    pairs = {("a", "a"): 2, ("a", "b"): 3}
    p = lambda w: 0.4 * (count[w] + 1) / (total + known + 1) + 0.6 * pairs.get(("a", w), 0) / 5
    assert sum(p(w) for w in [*count, "unknown"]) == pytest.approx(1)


def test_empty_table_and_nothing_to_learn_from(make_docs):
    assert lm.score(make_docs([])).count() == 0
    key = next(k for k in range(50) if apart(k))
    got = lm.score(make_docs([(key, "a b")])).first()
    assert got["held_out"] and got["n_known"] == 0 and got["train_tokens"] == 0
    assert got["base_score"] == got["score"] == 0.0


def test_mixture_weighs_what_left_out_tokens_say():
    c = 3 * lm.CELLS
    never = lm.mixture(np.array([c]), np.array([10.0]), 100.0)
    often = lm.mixture(np.array([c + 200, c]), np.array([9.0, 1.0]), 1e6)
    assert never[3] < 1e-5 and 0.8 < often[3] < 0.95 and often[0] == 0
    assert (often[1:3] == often[3]).all()


@pytest.mark.parametrize("n,top", [(1, 1), (5, 3), (1000, 1 << 20), (1000, 1500), (5000, 1 << 50), (4000, 100)])
def test_elias_fano(n, top, tmp_path):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n).astype(np.uint64))
    for folder in (None, str(tmp_path)):
        own = nt.EliasFano(values, folder)
        assert (own.get(np.arange(n)) == values).all()
        asked = np.concatenate([values, rng.integers(0, 2 * top, n).astype(np.uint64)])
        lo = np.zeros(len(asked), np.int64)
        at = own.find(asked, lo, lo + n)
        assert ((at >= 0) == np.isin(asked, values)).all() and (values[at[at >= 0]] == asked[at >= 0]).all()


def test_trie_searches_within_a_context():
    rng = np.random.default_rng(2)
    pairs = {(int(a), int(b)): int(c) for a, b, c in rng.integers(1, 300, (4000, 3))}
    keys = sorted(pairs)
    context, word = (np.array([k[i] for k in keys], np.uint64) for i in (0, 1))
    trie = nt.Trie(context, word, np.array([pairs[k] for k in keys]))
    asked = rng.integers(0, 320, (5000, 2)).astype(np.uint64)
    got = nt.restored(trie.lookup(asked[:, 0], asked[:, 1]))
    for (a, b), c in zip(asked.tolist(), got):
        assert c == pytest.approx(pairs.get((a, b), 0), rel=0.06)
    assert (nt.Trie(context[:0], word[:0], np.zeros(0)).lookup(asked[:, 0], asked[:, 1]) == 0).all()


@pytest.mark.parametrize("kind", ["smallint", "int", "decimal(12,0)", "string", "date"])
def test_keys_of_any_type_and_clashing_names(make_docs, kind):
    rows = [(k, t) for k, t in corpus(random.Random(6))[:40] if k is not None]
    cast = f"CAST({'date_add(DATE 2020-01-01, CAST(doc_id AS int))' if kind == 'date' else f'doc_id AS {kind}'}" + ("" if kind != "date" else " AS date") + ") AS doc_id"
    docs = make_docs(rows).selectExpr(cast.replace("DATE 2020-01-01", "DATE '2020-01-01'"), "text", "1 AS k", "2 AS t", "3 AS shard", "4 AS kind", "5 AS score")
    got = lm.score(docs)
    assert dict(got.dtypes)["doc_id"] == kind and got.count() == len(rows)
    assert sorted(r["doc_id"] for r in got.select("doc_id").collect()) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
