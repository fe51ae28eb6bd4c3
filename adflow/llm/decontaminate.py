"""Benchmark passages in documents, found with an FM-index per shard of texts.

The phrases (windows of benchmark words) are a stated query set. Tasks make them in blocks of
about ``BLOCK_BYTES`` of benchmark text and never of more than twice that; the driver reads one
block at a time. There is a pass over the documents per block, each written to the shared folder
before the next, so neither a task nor the plan grows with the benchmark. Documents are not
shuffled: a row stays a row.

An index is built over the alphabet of its block's phrases. A word that no phrase has
ends a stretch, and stretches shorter than the shortest phrase are left out of the index
because no phrase fits into them; both leave every occurrence in place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adflow.llm.fm_index import FMIndex
from adflow.llm.stage import staged
from adflow.llm.text import NOT_ALNUM, Texts, slices

WINDOW = 10
BLOCK_BYTES = 4 << 20
SHARD_SYMBOLS = 1 << 20
SHARD_BYTES = 1 << 23
_BREAK = 1

_HIT = pa.struct([("word", pa.int64()), ("words", pa.int64()),
                  ("byte", pa.int64()), ("bytes", pa.int64())])


@dataclass
class Phrases:
    """Distinct windows of a block: symbols (2 and up), lengths, and the items that have each."""

    vocabulary: np.ndarray
    symbols: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]

    @classmethod
    def of(cls, rows: list[tuple[str, str]], window: int) -> Phrases:
        words = Texts.of(pa.array([t for _, t in rows], pa.string()), lower=True).words(NOT_ALNUM)
        hashes = words.hashes()
        vocabulary = np.unique(hashes)
        symbols = np.searchsorted(vocabulary, hashes) + 2
        found: dict[tuple[int, ...], set[str]] = {}
        for r, (item, _) in enumerate(rows):
            own = symbols[words.first[r]:words.first[r + 1]].tolist()
            for k in range(max(len(own) - window, 0) + 1 if own else 0):
                found.setdefault(tuple(own[k:k + window]), set()).add(item)
        padded = np.zeros((len(found), window), np.int64)
        for k, phrase in enumerate(found):
            padded[k, :len(phrase)] = phrase
        return cls(vocabulary, padded, np.array([len(p) for p in found], np.int64),
                   [sorted(v) for v in found.values()])


def _pieces(text: str, window: int, most: int) -> Iterator[str]:
    """A text of more than ``most`` bytes in stretches that have all its windows between them."""
    raw = text.encode()
    if len(raw) <= most:
        yield text
        return
    words = Texts.of(pa.array([text], pa.string())).words(NOT_ALNUM)
    at, end, n = 0, 0, len(words.start)
    while end < n:
        end = max(int(np.searchsorted(words.end, words.start[at] + most, "right")), at + window)
        yield raw[words.start[at]:words.end[min(end, n) - 1]].decode()
        at = end - window + 1


def _parts(rows: list[tuple[str, str]], window: int, most: int) -> Iterator[list[tuple[str, str]]]:
    own, size = [], 0
    for item, text in rows:
        for piece in _pieces(text, window, most):
            if own and size + len(piece) > 2 * most:
                yield own
                own, size = [], 0
            own.append((item, piece))
            size += len(piece)
    yield own


_BLOCK = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("vocabulary", pa.binary()),
                    ("symbols", pa.binary()), ("lengths", pa.binary()),
                    ("items", pa.list_(pa.list_(pa.string())))])


def blocks(benchmark: DataFrame, window: int, most: int, item: str, text: str) -> Iterator[Phrases]:
    """All phrases of the benchmark, a block at a time; a block without phrases is left out."""
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"),
                            F.col(text).alias("text")).where("text IS NOT NULL").distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(-(-size // most), 1)

    def build(group: pa.Table) -> pa.Table:
        own = sorted(zip(group.column("item").to_pylist(), group.column("text").to_pylist()))
        out = []
        for part, chosen in enumerate(_parts(own, window, most)):
            p = Phrases.of(chosen, window)
            if len(p.lengths):
                out.append((group.column("block")[0].as_py(), part, p.vocabulary.tobytes(),
                            p.symbols.astype(np.int32).tobytes(), p.lengths.tobytes(), p.items))
        return pa.Table.from_pylist([dict(zip(_BLOCK.names, r)) for r in out], _BLOCK)

    table = staged(rows.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(count))).groupBy(
        "block").applyInArrow(build, "block bigint, part bigint, vocabulary binary, symbols binary, "
                              "lengths binary, items array<array<string>>"), "phrases")
    for r in table.select("block", "part").orderBy("block", "part").collect():
        own = table.where((F.col("block") == r["block"]) & (F.col("part") == r["part"])).first()
        yield Phrases(np.frombuffer(own["vocabulary"], np.uint64),
                      np.frombuffer(own["symbols"], np.int32).reshape(-1, window).astype(np.int64),
                      np.frombuffer(own["lengths"], np.int64), own["items"])


class _Shard:
    """Slices of texts that are searched together."""

    def __init__(self, phrases: Phrases, most: int):
        self.phrases, self.most, self.parts, self.size, self.bytes = phrases, most, [], 0, 0
        self.least = int(phrases.lengths.min()) if len(phrases.lengths) else 1 << 60

    def add(self, batch: pa.RecordBatch) -> None:
        words = Texts.of(batch.column("__text"), lower=True).words(NOT_ALNUM)
        rows, known = words.rows(), self.phrases.vocabulary
        hashes = words.hashes()
        at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
        inside = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
        # Stretches of phrase words within one text.
        begin, end = inside.copy(), inside.copy()
        same = inside[1:] & inside[:-1] & (rows[1:] == rows[:-1])
        begin[1:] &= ~same
        end[:-1] &= ~same
        first, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
        long = stop - first >= self.least
        first, stop = first[long], stop[long]
        size = stop - first
        place = np.repeat(first - np.concatenate([[0], np.cumsum(size + 1)[:-1]]), size + 1) + (
            np.arange(int((size + 1).sum()))) if len(size) else np.zeros(0, np.int64)
        symbols = at[np.minimum(place, len(at) - 1)] + 2 if len(place) else place
        symbols[np.cumsum(size + 1) - 1] = _BREAK
        self.parts.append((batch, words, rows, place, symbols))
        self.size += len(symbols)
        self.bytes += batch.column("__text").nbytes

    def full(self) -> bool:
        return self.size >= self.most or self.bytes >= SHARD_BYTES

    def found(self) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list, list]]:
        """Per slice: the batch, words per text, merged hits and items per text."""
        phrases, starts = self.phrases, np.zeros(0, np.int64)
        which = np.zeros(0, np.int64)
        if self.size:
            index = FMIndex(np.concatenate([p[4] for p in self.parts]))
            lo, hi = index.search(phrases.symbols, phrases.lengths)
            count = hi - lo
            which = np.repeat(np.arange(len(lo)), count)
            rows = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + (
                np.arange(int(count.sum())))
            starts = index.locate(rows)
        order = np.argsort(starts, kind="stable")
        starts, which, base = starts[order], which[order], 0
        for batch, words, rows, place, symbols in self.parts:
            a, b = np.searchsorted(starts, [base, base + len(symbols)])
            word, phrase = place[starts[a:b] - base], which[a:b]
            base += len(symbols)
            n = batch.num_rows
            change = np.zeros(len(rows) + 1, np.int64)
            np.add.at(change, word, 1)
            np.add.at(change, word + phrases.lengths[phrase], -1)
            hit = np.cumsum(change[:-1]) > 0
            hits: list[list] = [[] for _ in range(n)]
            edge = hit.copy()
            edge[1:] &= ~(hit[:-1] & (rows[1:] == rows[:-1]))
            tail = hit.copy()
            tail[:-1] &= ~(hit[1:] & (rows[1:] == rows[:-1]))
            for k, m in zip(np.flatnonzero(edge).tolist(), np.flatnonzero(tail).tolist()):
                r = int(rows[k])
                byte = int(words.start[k] - words.texts.at[r])
                hits[r].append((k - int(words.first[r]), m + 1 - k,
                                byte, int(words.end[m] - words.start[k])))
            items: list[set] = [set() for _ in range(n)]
            for r, p in set(zip(rows[word].tolist(), phrase.tolist())):
                items[r].update(phrases.items[p])
            yield batch, words.counts, hits, items


def _merged(own: list[tuple], before: list[dict] | None) -> list[tuple]:
    """Hits of two passes over one text, overlapping or adjoining ones joined."""
    if not before:
        return own
    out: list[tuple] = []
    for word, words, byte, size in sorted(own + [tuple(h.values()) for h in before]):
        if out and word <= out[-1][0] + out[-1][1]:
            w, ws, b, s = out[-1]
            out[-1] = (w, max(ws, word + words - w), b, max(s, byte + size - b))
        else:
            out.append((word, words, byte, size))
    return out


def _pass(df: DataFrame, phrases: Phrases, keep: list[str], first: bool, most: int) -> DataFrame:
    def emit(shard):
        for batch, counts, hits, items in shard.found():
            if not first:
                hits = [_merged(h, b) for h, b in zip(hits, batch.column("hits").to_pylist())]
                items = [i | set(b) for i, b in zip(items, batch.column("items").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in [*keep, "__text"]] + [
                    pa.array(counts.astype(np.int64)),
                    pa.array([[dict(zip(_HIT.names, h)) for h in row] for row in hits],
                             pa.list_(_HIT)),
                    pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                ], names=[*keep, "__text", "n_words", "hits", "items"])

    def run(batches):
        shard = _Shard(phrases, most)
        for batch in slices(batches, "__text"):
            shard.add(batch)
            if shard.full():
                yield from emit(shard)
                shard = _Shard(phrases, most)
        yield from emit(shard)

    types = dict(df.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in [*keep, "__text"]) + (
        ", n_words bigint, hits array<struct<word:bigint,words:bigint,byte:bigint,bytes:bigint>>"
        ", items array<string>")
    return df.mapInArrow(run, schema)


def find(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text",
         item: str = "item_id", item_text: str = "text", window: int = WINDOW,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep`` columns, the text as ``__text``, ``n_words``, merged ``hits`` (word and byte
    ranges of the text) and the sorted ``items`` with an occurring window.

    A null or empty text has no words and no hits. An item without words is never found;
    items that share an id are one; a null id is the empty string. Repeated documents each
    get a row. With no items nothing is hit.
    """
    df = docs.select(*keep, F.col(text).alias("__text"))
    first = True
    for phrases in blocks(benchmark, window, block_bytes, item, item_text):
        df = df if first else staged(df, "hits")
        df, first = _pass(df, phrases, keep, first, SHARD_SYMBOLS), False
    return _pass(df, Phrases.of([], window), keep, True, SHARD_SYMBOLS) if first else df


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id",
                  **options) -> DataFrame:
    """Per document: words, hit words, found items and their digest."""
    found = find(docs.select(F.col(key).alias("k"), options.pop("text", "text")), benchmark,
                 ["k"], **options)
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, h: total + h["words"])
    return found.select(
        F.col("k").alias(key), "n_words", hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


def cut(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with every hit range of the text cut out; the other columns stay as they are.

    A null text stays null.
    """
    found = find(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text] or [
        F.lit(1).alias("none")]).alias("__row"), F.col(text)), benchmark, ["__row"], text, **options)
    raw = F.col("__text").cast("binary")

    def step(state, h):
        return F.struct(
            F.concat(state["out"], F.substring(raw, state["at"], h["byte"] + 1 - state["at"]))
            .alias("out"), (h["byte"] + h["bytes"] + 1).cast("int").alias("at"))

    start = F.struct(F.lit(b"").cast("binary").alias("out"), F.lit(1).alias("at"))
    kept = F.aggregate(
        F.transform("hits", lambda h: F.struct(h["byte"].cast("int").alias("byte"),
                                               h["bytes"].cast("int").alias("bytes"))),
        start, step, lambda s: F.concat(s["out"], F.substring(raw, s["at"], F.length(raw)))
        .cast("string"))
    return found.select(*[
        F.when(F.size("hits") > 0, kept).otherwise(F.col("__text")).alias(text) if c == text
        else F.col("__row")[c].alias(c) for c in docs.columns])
