"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: the distinct hashes of its lower-cased words, word pairs, and pairs
with one word between them, in 2^22 places. The model is fitted on a bounded sample of
labelled documents; L1 leaves few weights, which travel with the scoring tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adflow.llm.stage import held_out, labelled_sample, sample_shift
from adflow.llm.text import NOT_ALNUM, Texts, Words, mix, slices, windows

PLACES = 1 << 22
SAMPLE = 4000  # labelled documents per class, at most
EPOCHS = 10
ALPHA, BETA, L2 = 1.0, 1.0, 0.1
L1_PER_EXAMPLE, L1_LEAST = 1 / 700, 1.0


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text and place of every word, pair and skip pair (with repeats)."""
    hashes, rows = words.hashes(), words.rows()
    at, pairs = windows(hashes, rows, 2)
    skip = np.flatnonzero(rows[2:] == rows[:-2]) if len(rows) > 2 else np.zeros(0, np.int64)
    skips = mix(hashes[skip] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[skip + 2])
    places = np.concatenate([hashes, pairs, skips]) & np.uint64(PLACES - 1)
    return np.concatenate([rows, rows[at], rows[skip]]), places.astype(np.int64)


def _words(column: pa.Array) -> Words:
    return Texts.of(column, lower=True).words(NOT_ALNUM)


@dataclass
class Model:
    """Sparse weights: sorted places, their weights, and the intercept."""

    places: np.ndarray
    weights: np.ndarray
    intercept: float

    def scores(self, column: pa.Array) -> np.ndarray:
        rows, places = features(_words(column))
        known = np.zeros(PLACES >> 3, np.uint8)
        np.bitwise_or.at(known, self.places >> 3, (1 << (self.places & 7)).astype(np.uint8))
        hit = (known[places >> 3] >> (places & 7)) & 1 == 1
        own = np.unique(rows[hit] * PLACES + places[hit])
        weight = self.weights[np.searchsorted(self.places, own % PLACES)]
        total = np.bincount(own // PLACES, weights=weight, minlength=len(column))
        return 1 / (1 + np.exp(-np.clip(total + self.intercept, -35, 35)))


def fit(examples: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """FTRL-proximal with per-coordinate rates over examples of distinct places.

    Places that only one example has are left out: they say nothing about others. The L1
    strength follows the number of examples, as gradients add up over them. Without
    examples of both classes the model is a constant.
    """
    if not len(examples) or labels.min() == labels.max():
        mean = float(labels.mean()) if len(labels) else 0.0
        return Model(np.zeros(0, np.int64), np.zeros(0), 35.0 if mean == 1 else -35.0)
    seen = np.zeros(PLACES, np.int32)
    for e in examples:
        seen[e] += 1
    places = np.flatnonzero(seen > 1)
    examples = [np.searchsorted(places, e[seen[e] > 1]).astype(np.int32) for e in examples]
    # The last place is the intercept, which has no penalty.
    z, n = np.zeros(len(places) + 1), np.zeros(len(places) + 1)
    w = np.zeros(len(places) + 1)
    strength = max(L1_LEAST, L1_PER_EXAMPLE * len(examples))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(examples)):
            own = np.append(examples[k], len(places))
            p = 1 / (1 + np.exp(-np.clip(w[own].sum(), -35, 35)))
            g = p - labels[k]
            root = np.sqrt(n[own])
            n[own] += g * g
            z[own] += g - (np.sqrt(n[own]) - root) / ALPHA * w[own]
            shrunk = np.sign(z[own]) * np.maximum(np.abs(z[own]) - strength, 0)
            shrunk[-1] = z[-1]
            w[own] = -shrunk / ((BETA + np.sqrt(n[own])) / ALPHA + L2)
    kept = np.flatnonzero(w[:-1])
    return Model(places[kept], w[kept], float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = SAMPLE,
          parts: int = 5, rest: int = 0) -> Model:
    """Fit on at most ``most`` documents of each class that are not held out, and shift the
    scores to the classes' shares among all such labels."""

    def run(batches):
        for batch in slices(batches):
            rows, places = features(_words(batch.column("text")))
            own = np.unique(rows * PLACES + places)
            cut = np.searchsorted(own // PLACES, np.arange(batch.num_rows + 1))
            blobs = [(own[a:b] % PLACES).astype("<i4").tobytes() for a, b in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label").cast(pa.int32()),
                 pa.array(blobs, pa.binary())], names=["key", "label", "places"])

    sample = labelled_sample(docs, labels, label, most, parts, rest)
    key = dict(sample.dtypes)["key"]
    rows = sorted(sample.mapInArrow(
        run, f"key {key}, label int, places binary").toLocalIterator(),
        key=lambda r: (r["key"], r["places"]))
    model = fit([np.frombuffer(r["places"], "<i4") for r in rows],
                np.array([r["label"] for r in rows], np.float64))
    model.intercept += sample_shift(labels, label, most, parts, rest)
    return model


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``score`` and ``predicted``. A null or empty text has no feature, so
    its score is the intercept's; repeated rows score alike."""
    picked = docs.select(*keep) if text in keep else docs.select(*keep, text)

    def run(batches):
        for batch in slices(batches, text):
            own = model.scores(batch.column(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keep]
                + [pa.array(own), pa.array((own >= 0.5).astype(np.int32))],
                names=[*keep, "score", "predicted"])

    types = dict(picked.dtypes)
    return picked.mapInArrow(run, ", ".join(
        [f"`{k}` {types[k]}" for k in keep] + ["score double", "predicted int"]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Texts are read whole, however long; a score of exactly one half is predicted 1. A row
    without a key has no label and is never held out. Other columns are not read, whatever they
    are called. An empty table gives no row; without labels of both classes every score is that
    of the class there is, 0 without any.
    """
    scored = score(docs, train(docs, labels), ["doc_id"])
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"),
                         "score", "predicted")
