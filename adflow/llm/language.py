"""Language by hierarchical discrimination: the family first, then linear support vector
machines, one against one, between the languages of that family.

Features of a text: counts of its byte 2-, 3- and 4-grams (lower-cased, other ASCII than
letters as one blank) in 2^11 places, square-rooted and scaled to length one.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adflow.llm.stage import held_out
from adflow.llm.text import Texts, slices

PLACES = 1 << 11
SAMPLE = 400  # training texts per language, at most
ORDERS = (2, 3, 4)

# Families of ISO 639-1 codes. Any other code is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi fo",
    "romance": "fr es pt it ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "celtic": "ga gd cy br",
    "turkic": "tr az kk uz ky tk tt",
    "semitic": "ar he am mt",
    "iranian": "fa ps ku tg",
    "indo-aryan": "hi ur bn mr gu pa ne si",
    "dravidian": "ta te kn ml",
    "austronesian": "id ms jv tl mg",
    "bantu": "sw zu xh rw sn",
}
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = ord(" ")
for _c in range(ord("a"), ord("z") + 1):
    _FOLD[_c] = _FOLD[_c - 32] = _c


def family(lang: str) -> str:
    return _FAMILY.get(lang, lang)


def vectors(column: pa.Array) -> np.ndarray:
    """A row of features per text; a text without n-grams has zeros."""
    texts = Texts.of(column)
    data, n = _FOLD[texts.data].astype(np.uint32), len(column)
    room = np.repeat(texts.at[1:], np.diff(texts.at)) - np.arange(len(data))
    base = (np.repeat(np.arange(n), np.diff(texts.at)) * PLACES).astype(np.int64)
    out = np.zeros(n * PLACES, np.float64)
    gram = data.copy()
    blank = data == ord(" ")
    for k in range(1, max(ORDERS)):
        gram[:-k] = (gram[:-k] << np.uint32(8)) | data[k:]
        if k + 1 in ORDERS:
            place = (gram * np.uint32(0x9E3779B1) + np.uint32(k)) * np.uint32(0x85EBCA6B)
            place >>= np.uint32(21)
            # N-grams of blanks alone say nothing.
            own = (room > k) & ~(blank & np.roll(blank, -1))
            out += np.bincount(base[own] + place[own], minlength=len(out))
    rows = np.sqrt(out.reshape(n, PLACES))
    return (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)).astype(
        np.float32)


def has_letter(column: pa.Array) -> np.ndarray:
    plain = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False)
    return plain.to_numpy(zero_copy_only=False)


def svm(x: np.ndarray, y: np.ndarray, epochs: int = 30, c: float = 10.0) -> np.ndarray:
    """Linear support vector machine by dual coordinate descent; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    norm = (x * x).sum(axis=1)
    order = np.random.default_rng(3)
    for _ in range(epochs):
        moved = 0.0
        for k in order.permutation(len(x)):
            slope = y[k] * (x[k] @ w) - 1
            new = min(max(alpha[k] - slope / norm[k], 0.0), c)
            if new != alpha[k]:
                w += (new - alpha[k]) * y[k] * x[k]
                moved = max(moved, abs(new - alpha[k]))
                alpha[k] = new
        if moved < 1e-3:
            break
    return w


def platt(margin: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Sigmoid over margins, by Newton's method, with smoothed targets."""
    up, down = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        g, h = p - target, p * (1 - p) + 1e-6
        grad = np.array([(g * margin).sum(), g.sum()])
        hess = np.array([[(h * margin * margin).sum() + 1e-3, (h * margin).sum()],
                         [(h * margin).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return a, b


@dataclass
class Duel:
    """One against one among ``names``; probabilities are the mean of the pairwise ones."""

    names: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray = None
    sigmoids: np.ndarray = None

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Duel:
        out = cls(sorted(set(y.tolist())))
        out.pairs = list(combinations(range(len(out.names)), 2))
        weights, sigmoids = [], []
        for i, j in out.pairs:
            own = (y == out.names[i]) | (y == out.names[j])
            sign = np.where(y[own] == out.names[i], 1.0, -1.0)
            w = svm(x[own], sign)
            weights.append(w)
            sigmoids.append(platt(x[own] @ w[:-1] + w[-1], sign))
        out.weights = np.array(weights, np.float32).reshape(len(out.pairs), x.shape[1] + 1)
        out.sigmoids = np.array(sigmoids).reshape(len(out.pairs), 2)
        return out

    def shares(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros((len(x), len(self.names)))
        if not self.pairs:
            return total + 1.0
        margin = x @ self.weights[:, :-1].T + self.weights[:, -1]
        p = 1 / (1 + np.exp(-np.clip(margin * self.sigmoids[:, 0] + self.sigmoids[:, 1], -35, 35)))
        for k, (i, j) in enumerate(self.pairs):
            total[:, i] += p[:, k]
            total[:, j] += 1 - p[:, k]
        return total / total.sum(axis=1, keepdims=True)


@dataclass
class Model:
    families: Duel
    within: dict[str, Duel]

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Language and score; ``und`` with score 0 where there is no letter or no model."""
        lang, score = np.full(len(column), "und", object), np.zeros(len(column))
        own = np.flatnonzero(has_letter(column))
        if not len(own) or not self.families.names:
            return lang, score
        x = vectors(column.take(pa.array(own)))
        share = self.families.shares(x)
        first = share.argmax(axis=1)
        for k, name in enumerate(self.families.names):
            rows = np.flatnonzero(first == k)
            if len(rows):
                inner = self.within[name].shares(x[rows])
                best = inner.argmax(axis=1)
                lang[own[rows]] = np.array(self.within[name].names, object)[best]
                # A duel's mean share of k names is at most 2 / k.
                top = inner.max(axis=1) * max(len(self.within[name].names) / 2, 1)
                outer = share[rows, k] * max(len(self.families.names) / 2, 1)
                score[own[rows]] = np.minimum(top, 1) * np.minimum(outer, 1)
        return lang, score


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    groups = np.array([family(v) for v in y.tolist()], object)
    return Model(Duel.fit(x, groups), {
        g: Duel.fit(x[groups == g], y[groups == g]) for g in sorted(set(groups.tolist()))})


def train(docs: DataFrame, most: int = SAMPLE, parts: int = 5, rest: int = 0) -> Model:
    """Fit on at most ``most`` texts of each language that are not held out, the first in
    hash order. Only their ids are broadcast, only their features reach the driver."""
    known = docs.select("doc_id", "lang").where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", parts, rest))
    picked = known.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(64)).alias("salt"))
    # Within salts first, so that a language of a third of all rows is not in one task.
    for groups in (("lang", "salt"), ("lang",)):
        rank = F.row_number().over(
            Window.partitionBy(*groups).orderBy(F.xxhash64("doc_id"), "doc_id"))
        picked = picked.withColumn("rank", rank).where(F.col("rank") <= most)
    picked = picked.select(F.col("doc_id").alias("key"), F.col("lang").alias("name"))
    texts = docs.select(F.col("doc_id").alias("key"), F.col("lang").alias("name"), "text").join(
        F.broadcast(picked.distinct()), ["key", "name"])

    def run(batches):
        for batch in slices(batches):
            own = has_letter(batch.column("text"))
            batch = batch.filter(pa.array(own))
            if batch.num_rows:
                x = np.round(vectors(batch.column("text")) * 65535).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), batch.column("name"),
                     pa.array([r.tobytes() for r in x], pa.binary())],
                    names=["key", "name", "features"])

    key = dict(texts.dtypes)["key"]
    rows = sorted(texts.mapInArrow(run, f"key {key}, name string, features binary")
                  .toLocalIterator(), key=lambda r: (r["name"], r["key"], r["features"]))
    x = np.array([np.frombuffer(r["features"], "<u2") for r in rows], np.float32).reshape(
        len(rows), PLACES) / 65535
    return fit(x, np.array([r["name"] for r in rows], object))


def identify(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score``, from the text alone.

    A null text, or one without a letter, is ``und`` with score 0; so is every text if
    there was nothing to learn from. Repeated rows are treated alike.
    """
    picked = docs.select(*keep, F.col(text).alias("__text"))

    def run(batches):
        for batch in slices(batches, "__text"):
            lang, score = model.predict(batch.column("__text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keep]
                + [pa.array(lang, pa.string()), pa.array(score)],
                names=[*keep, "lang_pred", "score"])

    types = dict(picked.dtypes)
    return picked.mapInArrow(run, ", ".join(
        [f"`{k}` {types[k]}" for k in keep] + ["lang_pred string", "score double"]))


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document.

    Texts are read whole, however long. Of equal shares the first name in alphabetical order
    wins. A row without a key is not learned from and never held out. Columns besides doc_id,
    text and lang are not read, whatever they are called. An empty table gives no row.
    """
    return identify(docs, train(docs), ["doc_id"]).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")
