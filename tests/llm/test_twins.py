"""The fitted operators against slow twins: dictionaries, loops and plain solvers."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from adflow.llm import language as lg
from adflow.llm import quality as ql
from adflow.llm import toxicity as tx
from adflow.llm.text import mix

from .conftest import words

ODD = ["", None, " \n\t ", "one", "Two two", "a b a b a b", "日本語 テキスト ÉA", "a\x00b \x1c c!", "x " * 500]


def texts_of(rng, n=40):
    return ODD + [" ".join(words(rng, rng.randrange(1, 60), 80)).title() for _ in range(n)]


def word_hash(word, lower=False):
    return int(ql.Texts.of(pa.array([word]), lower=lower).words().hashes()[0])


# Toxicity

def grams(text):
    """Words, pairs and pairs with one word between, as tuples."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return ({("word", a) for a in w} | {("pair", a, b) for a, b in zip(w, w[1:])}
            | {("skip", a, b) for a, b in zip(w, w[2:])})


def place_of(gram):
    """Where the operator puts a gram, asked by a text that has little else."""
    kind, *own = gram
    text = {"word": own[0], "pair": " ".join(own), "skip": " between ".join(own)}[kind]
    return int(tx.features(tx._words(pa.array([text])))[1][{"word": 0, "pair": 2, "skip": -1}[kind]])


class SlowFtrl:
    """FTRL-proximal, a dictionary entry per gram."""

    def __init__(self, strength):
        self.z, self.n, self.strength = defaultdict(float), defaultdict(float), strength

    def weight(self, gram):
        z = self.z[gram]
        if gram is not None:
            z = math.copysign(max(abs(z) - self.strength, 0.0), z)
        return -z / ((tx.BETA + math.sqrt(self.n[gram])) / tx.ALPHA + tx.L2)

    def probability(self, own):
        return 1 / (1 + math.exp(-min(max(sum(self.weight(g) for g in own), -35), 35)))

    def learn(self, own, label):
        old = {g: self.weight(g) for g in own}
        g1 = self.probability(own) - label
        for g in own:
            sigma = (math.sqrt(self.n[g] + g1 * g1) - math.sqrt(self.n[g])) / tx.ALPHA
            self.z[g] += g1 - sigma * old[g]
            self.n[g] += g1 * g1


def test_features_are_the_grams():
    rng = random.Random(1)
    texts = texts_of(rng)
    rows, places = tx.features(tx._words(pa.array(texts)))
    for k, text in enumerate(texts):
        assert set(places[rows == k].tolist()) == {place_of(g) for g in grams(text)}


def test_ftrl_equals_dictionaries():
    rng = random.Random(2)
    texts, labels = [], []
    for k in range(150):
        w = words(rng, 12, 40)
        if k % 3 == 0:
            w[rng.randrange(12)] = "rude"
        texts.append(" ".join(w))
        labels.append(float(k % 3 == 0))
    examples = [np.unique(tx.features(tx._words(pa.array([t])))[1]) for t in texts]
    model = tx.fit(examples, np.array(labels), epochs=3)
    seen = Counter(g for t in texts for g in grams(t))
    slow = SlowFtrl(max(tx.L1_LEAST, tx.L1_PER_EXAMPLE * len(texts)))
    order = np.random.default_rng(7)
    keep = lambda t: [g for g in sorted(grams(t)) if seen[g] > 1] + [None]  # noqa: E731  None is the intercept
    for _ in range(3):
        for k in order.permutation(len(texts)):
            slow.learn(keep(texts[k]), labels[k])
    weights = {place_of(g): slow.weight(g) for g in seen if seen[g] > 1}
    assert {p for p, w in weights.items() if w} == set(model.places.tolist())
    for place, weight in zip(model.places.tolist(), model.weights):
        assert weight == pytest.approx(weights[place], rel=1e-6)
    assert model.intercept == pytest.approx(slow.weight(None), rel=1e-6)
    fresh = texts[:20] + ODD
    assert model.scores(pa.array(fresh)) == pytest.approx([slow.probability(keep(t)) for t in fresh], rel=1e-6)


# Language

def slow_vector(text):
    """Byte n-grams counted one by one; other ASCII than letters is a blank."""
    own = bytes(c | 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in (text or "").encode())
    out = [0.0] * lg.PLACES
    for size in lg.ORDERS:
        for at in range(len(own) - size + 1):
            gram = own[at:at + size]
            if not gram.startswith(b"  "):
                value = (int.from_bytes(gram, "big") * 0x9E3779B1 + size - 1) % 2**32
                out[(value * 0x85EBCA6B % 2**32) >> 21] += 1
    length = math.sqrt(sum(out)) or 1.0
    return [math.sqrt(x) / length for x in out]


def test_language_features_by_loops():
    texts = texts_of(random.Random(3), 10)
    assert np.allclose(lg.vectors(pa.array(texts)), [slow_vector(t) for t in texts], atol=1e-6)


def slow_svm(x, y, c=10.0, rounds=20_000):
    """The dual by projected gradient over all multipliers at once."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    kernel = (x @ x.T) * np.outer(y, y)
    alpha, step = np.zeros(len(x)), 1 / np.linalg.eigvalsh(kernel)[-1]
    for _ in range(rounds):
        alpha = np.clip(alpha + step * (1 - kernel @ alpha), 0, c)
    return (alpha * y) @ x, alpha.sum() - alpha @ kernel @ alpha / 2


@pytest.mark.parametrize("seed", range(3))
def test_svm_against_a_plain_solver(seed):
    rng = np.random.default_rng(seed)
    y = np.where(np.arange(60) % 2 == 0, 1.0, -1.0)
    x = rng.standard_normal((60, 8)) + 0.8 * y[:, None] * rng.standard_normal(8)
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    primal = lambda w: w @ w / 2 + 10.0 * np.maximum(1 - y * (x @ w[:-1] + w[-1]), 0).sum()
    plain, dual = slow_svm(x, y)
    assert primal(plain) == pytest.approx(dual, rel=1e-2)
    w = lg.svm(x, y, epochs=2000)
    assert primal(w) == pytest.approx(dual, rel=1e-2)
    far = np.abs(x @ plain[:-1] + plain[-1]) > 0.1
    assert (np.sign(x @ w[:-1] + w[-1]) == np.sign(x @ plain[:-1] + plain[-1]))[far].all()


def slow_duel(duel, x):
    total = {n: 0.0 for n in duel.names}
    if not duel.pairs:
        return {n: 1.0 / len(duel.names) for n in duel.names}
    for (i, j), w, (a, b) in zip(duel.pairs, duel.weights, duel.sigmoids):
        margin = sum(p * q for p, q in zip(x, w)) + w[-1]
        p = 1 / (1 + math.exp(-min(max(a * margin + b, -35), 35)))
        total[duel.names[i]] += p
        total[duel.names[j]] += 1 - p
    all_of = sum(total.values())
    return {n: v / all_of for n, v in total.items()}


def test_hierarchy_by_loops():
    rng = random.Random(4)
    alphabets = {"en": "abcdefth", "de": "abcdefch", "nl": "abcdefgh", "fr": "oupqrst", "es": "oupqrsñ", "zz": "kkkjjx"}
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(12))
    rows = [(lang, make(a)) for lang, a in alphabets.items() for _ in range(15)]
    model = lg.fit(lg.vectors(pa.array([t for _, t in rows])), np.array([n for n, _ in rows], object))
    assert model.families.pairs == list(combinations(range(3), 2)) and len(model.within["germanic"].pairs) == 3
    fresh = [make(a) for a in alphabets.values() for _ in range(4)] + ["ab ou kk", "the é", "x1"]
    lang, score = model.predict(pa.array(fresh))
    for k, text in enumerate(fresh):
        x = slow_vector(text)
        outer = slow_duel(model.families, x)
        group = max(sorted(outer), key=outer.get)
        inner = slow_duel(model.within[group], x)
        best = max(sorted(inner), key=inner.get)
        want = min(inner[best] * max(len(inner) / 2, 1), 1) * min(outer[group] * max(len(outer) / 2, 1), 1)
        assert lang[k] == best and score[k] == pytest.approx(want, rel=1e-4)


# Quality

def slow_pool(text, vectors):
    """Means over the words, one by one."""
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    context, own, beside = (np.zeros(ql.WIDTH) for _ in range(3))
    shape = np.zeros(ql.SHAPE_WIDTH)
    index = [ql._OWN[(word_hash(x.decode()) >> 20) % len(ql._OWN)] for x in w]
    for k, x in enumerate(w):
        context += vectors[word_hash(x.decode()) % ql.WORDS]
        own += index[k]
        if k + 1 < len(w):
            beside += index[k] * index[k + 1]
        kinds = 0
        for c in x:
            kinds |= int(ql._KIND[c])
        shape += ql._SHAPE[int(mix(np.array([kinds], np.uint64))[0]) % len(ql._SHAPE)]
    return np.concatenate([np.concatenate([context, own, beside, shape]) / max(len(w), 1), [math.log1p(len(w))]])


def test_pooling_and_network_word_by_word():
    rng = random.Random(5)
    texts = texts_of(rng, 30)
    vectors = np.random.default_rng(1).standard_normal((ql.WORDS, ql.WIDTH)).astype(np.float32)
    x = ql.pooled(pa.array(texts), vectors)
    slow = [slow_pool(t, vectors) for t in texts]
    assert np.allclose(x, slow, atol=1e-4)
    y = np.array([float(k % 2) for k in range(len(texts))])
    net = ql.fit(x.astype(np.float64), y, epochs=5)
    net.shift = 0.3
    got = net.scores(x.astype(np.float64))
    for row, score in zip(slow, got):
        logit = net.b2
        for h in range(ql.HIDDEN):
            a = net.b1[h] + sum((v - m) / s * w for v, m, s, w in zip(row, net.mean, net.scale, net.w1[:, h]))
            logit += max(a, 0.0) * net.w2[h]
        assert score == pytest.approx(1 / (1 + math.exp(-(logit / net.temperature + net.shift))), abs=1e-3)
