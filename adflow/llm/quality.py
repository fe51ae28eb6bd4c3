"""Document quality from random-indexing word vectors and a two-layer network.

A word has a fixed random index vector; its context vector is the sum of the index vectors
of its neighbours over the whole corpus (added up in parallel, in ``WORDS`` hashed rows).
A document is the mean of its words' vectors; the network maps that to a probability,
whose temperature is fitted on rows that the network was not trained on.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adflow.llm.stage import held_out, labelled_sample
from adflow.llm.text import BLANK, Texts, mix, slices

WORDS = 1 << 14
WIDTH = 32
SHAPE_WIDTH = 16
REACH = 2
NONZERO = 2
BLOCK = 1 << 9
FAN = 32
SAMPLE = 4000  # labelled documents per class, at most
HIDDEN = 24

_rng = np.random.default_rng(11)
_OWN = _rng.standard_normal((1 << 12, WIDTH)).astype(np.float32)
_SHAPE = _rng.standard_normal((1 << 10, SHAPE_WIDTH)).astype(np.float32)

# What kinds of character a word has: a bit each for the classes, eleven for other signs.
_KIND = np.zeros(256, np.uint16)
_KIND[33:128] = 1 << (5 + np.arange(33, 128) % 11).astype(np.uint16)
_KIND[ord("A"):ord("Z") + 1] = 1
_KIND[ord("a"):ord("z") + 1] = 2
_KIND[ord("0"):ord("9") + 1] = 4
_KIND[128:] = 8


def _index(hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and sign of the k-th nonzero of each word's sparse index vector."""
    own = mix(hashes + np.uint64(k + 1))
    return (own % np.uint64(WIDTH)).astype(np.int64), 1.0 - 2.0 * (own >> np.uint64(63))


def contexts(column: pa.Array) -> np.ndarray:
    """Sums of neighbours' index vectors per word row, over some texts."""
    words = Texts.of(column).words()
    hashes, rows = words.hashes(), words.rows()
    base = (hashes & np.uint64(WORDS - 1)).astype(np.int64) * WIDTH
    total = np.zeros(WORDS * WIDTH)
    for k in range(NONZERO):
        place, sign = _index(hashes, k)
        for step in range(1, REACH + 1):
            near = np.flatnonzero(rows[step:] == rows[:-step])
            for word, other in ((near, near + step), (near + step, near)):
                total += np.bincount(base[word] + place[other], weights=sign[other],
                                     minlength=WORDS * WIDTH)
    return total


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Context vectors of all word rows, from every text; unit length, common part removed.

    Each task adds up its texts; the sums meet in a tree of groups of ``FAN``, block by
    block. What reaches the driver has a fixed size.
    """
    picked = docs.select(F.col(text).alias("t"))
    blocks = WORDS * WIDTH // (BLOCK * WIDTH)

    def run(batches):
        total = np.zeros(WORDS * WIDTH)
        for batch in slices(batches, "t"):
            total += contexts(batch.column("t"))
        if total.any():
            parts = total.astype("<i8").reshape(blocks, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(blocks), pa.int32()),
                 pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())],
                names=["block", "sums"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(s), "<i8")
                    for s in group.column("sums").to_pylist())
        return pa.table({"block": group.column("block")[:1], "part": group.column("part")[:1],
                         "sums": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    parts = picked.rdd.getNumPartitions()
    sums = picked.mapInArrow(run, "block int, sums binary").withColumn(
        "part", F.spark_partition_id())
    while parts > 1:
        sums = sums.withColumn("part", (F.col("part") / FAN).cast("int")).groupBy(
            "block", "part").applyInArrow(add, "block int, part int, sums binary")
        parts = -(-parts // FAN)
    out = np.zeros((blocks, BLOCK * WIDTH))
    for r in sums.toLocalIterator():
        out[r["block"]] += np.frombuffer(zlib.decompress(r["sums"]), "<i8")
    out = out.reshape(WORDS, WIDTH)
    out = out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)
    out -= out.mean(axis=0)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Means over a text's words: context, index and shape vectors, and the products of
    neighbours' index vectors; last the logarithm of its length. Zeros without words."""
    texts = Texts.of(column)
    words = texts.words()
    n = len(column)
    out = np.zeros((n, 3 * WIDTH + SHAPE_WIDTH + 1), np.float32)
    counts = words.counts
    out[:, -1] = np.log1p(counts)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    hashes = words.hashes()
    kinds = np.bitwise_or.reduceat(np.where(BLANK[texts.data], 0, _KIND[texts.data]), words.start)
    first = words.first[full]
    own = _OWN[(hashes >> np.uint64(20)) & np.uint64(len(_OWN) - 1)]
    beside = np.zeros_like(own)
    beside[:-1] = own[:-1] * own[1:]
    beside[words.first[full + 1] - 1] = 0
    shape = (mix(kinds.astype(np.uint64)) & np.uint64(len(_SHAPE) - 1)).astype(np.int64)
    at = 0
    for part in (vectors[hashes & np.uint64(WORDS - 1)], own, beside, _SHAPE[shape]):
        width = part.shape[1]
        out[full, at:at + width] = np.add.reduceat(part, first, axis=0) / counts[full, None]
        at += width
    return out


@dataclass
class Network:
    """Standardisation, two layers, temperature and prior shift."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0
    shift: float = 0.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        own = self.logits(x) / self.temperature + self.shift
        return 1 / (1 + np.exp(-np.clip(own, -35, 35)))


def fit(x: np.ndarray, y: np.ndarray, epochs: int = 60, batch: int = 64, rate: float = 3e-3,
        decay: float = 1e-3) -> Network:
    """Adam on four fifths of the rows; the temperature from the rest. With one class only
    the network is a constant."""
    width = x.shape[1]
    if not len(y) or y.min() == y.max():
        sure = 35.0 if len(y) and y[0] == 1 else -35.0
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1),
                       np.zeros(1), sure)
    rng = np.random.default_rng(5)
    order = rng.permutation(len(y))
    apart, own = order[::5], np.delete(order, np.s_[::5])
    net = Network(x[own].mean(axis=0), x[own].std(axis=0) + 1e-3,
                  rng.standard_normal((width, HIDDEN)) * np.sqrt(2 / width), np.zeros(HIDDEN),
                  rng.standard_normal(HIDDEN) * np.sqrt(1 / HIDDEN), 0.0)
    z = (x - net.mean) / net.scale
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(own), max(len(own) // batch, 1)):
            a = z[rows] @ params[0] + params[1]
            h = np.maximum(a, 0)
            p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3][0], -35, 35)))
            d = (p - y[rows]) / len(rows)
            back = np.outer(d, params[2]) * (a > 0)
            grads = [z[rows].T @ back + decay * params[0], back.sum(axis=0),
                     h.T @ d + decay * params[2], np.array([d.sum()])]
            step += 1
            for param, grad, (m, v) in zip(params, grads, moments):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                param -= rate * (m / (1 - 0.9 ** step)) / (
                    np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    net.b2 = float(params[3][0])
    if len(apart):
        logits = net.logits(x[apart])
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        loss = [np.logaddexp(0, np.where(y[apart] == 1, -logits, logits) / t).mean()
                for t in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, label: str = "quality",
          most: int = SAMPLE, parts: int = 3, rest: int = 1) -> Network:
    """Fit on at most ``most`` labelled documents of each class that are not held out, and
    shift the scores to the classes' shares among all such documents."""

    def run(batches):
        for batch in slices(batches):
            x = pooled(batch.column("text"), vectors)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label").cast(pa.int32()),
                 pa.array([r.astype("<f4").tobytes() for r in x], pa.binary())],
                names=["key", "label", "features"])

    sample = labelled_sample(docs, labels, label, most, parts, rest)
    key = dict(sample.dtypes)["key"]
    rows = sorted(sample.mapInArrow(run, f"key {key}, label int, features binary")
                  .toLocalIterator(), key=lambda r: (r["key"], r["features"]))
    x = np.array([np.frombuffer(r["features"], "<f4") for r in rows], np.float64).reshape(
        len(rows), 3 * WIDTH + SHAPE_WIDTH + 1)
    y = np.array([r["label"] for r in rows], np.float64)
    net = fit(x, y)
    sizes = {r[label]: r["count"] for r in labels.where(
        F.col(label).isin(0, 1) & ~held_out("doc_id", parts, rest)).groupBy(label).count().collect()}
    if len(sizes) == 2 and 0 < y.mean() < 1:
        net.shift = float(np.log(sizes[1] / sizes[0]) - np.log(y.sum() / (len(y) - y.sum())))
    return net


def score(docs: DataFrame, vectors: np.ndarray, net: Network, keep: list[str],
          text: str = "text") -> DataFrame:
    """``keep`` columns, ``score`` and ``predicted``. A null or empty text is scored as one
    without words; repeated rows score alike."""
    picked = docs.select(*keep, F.col(text).alias("__text"))

    def run(batches):
        for batch in slices(batches, "__text"):
            own = net.scores(pooled(batch.column("__text"), vectors).astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keep]
                + [pa.array(own), pa.array((own >= 0.5).astype(np.int32))],
                names=[*keep, "score", "predicted"])

    types = dict(picked.dtypes)
    return picked.mapInArrow(run, ", ".join(
        [f"`{k}` {types[k]}" for k in keep] + ["score double", "predicted int"]))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Texts are read whole, however long; a score of exactly one half is predicted 1. A row
    without a key has no label and is never held out, but its words count for the vectors, as
    do those of each repeated row. Other columns are not read, whatever they are called. An
    empty table gives no row; without labels of both classes every score is that of the class
    there is, 0 without any.
    """
    vectors = word_vectors(docs)
    return score(docs, vectors, train(docs, labels, vectors), ["doc_id"]).select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")
