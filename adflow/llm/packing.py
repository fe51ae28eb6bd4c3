"""Packing token sequences by patterns: a plan over the length histogram, applied in parallel.

1. Tokenise whole texts and cut long ones into pieces of the sequence size.
2. Count pieces per length. At most ``size`` counts reach the driver.
3. Enumerate patterns of up to three lengths on a coarser grid, fit their repeats to the
   histogram by non-negative least squares, round, and place what is left best fit first.
   Sequences that are not full are then taken apart and placed again, so that a plan never
   has more sequences than best fit alone would. The plan is a list of (lengths, repeats); its size depends on ``size``, not on the data.
4. Number the pieces of each length and look up the plan's slot of each number.
"""

from __future__ import annotations

import bisect
import itertools
import os
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adflow.llm.stage import staged
from adflow.llm.text import Texts, slices

SIZE = 2048
UNIT = 4
SALT_ROWS = 100_000
CACHED_WORDS = 3 << 18
SLICE_BYTES = 1 << 21
ROOMS = (256, 64, 16, 4, 0, -1)  # sequences with more room than this are placed again
VOCABULARY = "word_bpe_49k.json"
END = 0


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


def _vocabulary(path: str) -> str:
    if os.path.isabs(path):
        return path
    import public_tokenizers

    return public_tokenizers.path(path)


class WordTokens:
    """Token ids of white-space separated words, each encoded once while it is cached.

    The tokenizer drops white space and never joins across it, so a text's ids are those of
    its words in order.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(_vocabulary(path))
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def lookup(self, words) -> np.ndarray:
        """Index into ``at`` and ``size`` of each word."""
        hashes, first, place = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if len(self.hashes) > CACHED_WORDS:
            self.clear()
        known = np.searchsorted(self.hashes, hashes)
        fresh = np.ones(len(hashes), bool)
        inside = known < len(self.hashes)
        fresh[inside] = self.hashes[known[inside]] != hashes[inside]
        if fresh.any():
            data = words.texts.data.tobytes()
            new = [data[a:b].decode() for a, b in zip(
                words.start[first[fresh]].tolist(), words.end[first[fresh]].tolist())]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
            size = np.array([len(f) for f in found], np.int64)
            at = len(self.ids) + np.cumsum(size) - size
            self.ids = np.concatenate([self.ids, np.fromiter(
                itertools.chain.from_iterable(found), np.uint32, int(size.sum()))])
            spot = known[fresh]
            self.hashes = np.insert(self.hashes, spot, hashes[fresh])
            self.at = np.insert(self.at, spot, at)
            self.size = np.insert(self.size, spot, size)
            known = np.searchsorted(self.hashes, hashes)
        return known[place]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, every text closed by ``END``, and where each text starts."""
        words = Texts.of(column).words()
        if not len(words.start):
            return np.full(len(column), END, "<u4"), np.arange(len(column) + 1)
        index = self.lookup(words)
        size = np.insert(self.size[index], words.first[1:], 1)
        at = np.insert(self.at[index], words.first[1:], -1)
        ends = np.cumsum(size)
        flat = np.arange(int(ends[-1])) + np.repeat(at - (ends - size), size)
        closing = ends[words.first[1:] + np.arange(len(column))] - 1
        flat[closing] = 0
        out = self.ids[flat].astype("<u4") if len(self.ids) else np.zeros(len(flat), "<u4")
        out[closing] = END
        return out, np.concatenate([[0], closing + 1])


@lru_cache(maxsize=1)
def _word_tokens(path: str) -> WordTokens:
    """One per Python worker, so that later tasks find the words of earlier ones."""
    return WordTokens(path)


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE,
           vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``size`` tokens: key, piece, start, length, ids_crc32 and, if asked
    for, the ids as little-endian 32-bit numbers. A null or empty text is its end token."""
    picked = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    columns = ["k", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches):
        tokens = _word_tokens(vocabulary)
        for batch in slices(batches, "t", SLICE_BYTES):
            ids, at = tokens.encode(batch.column("t"))
            count = -(-np.diff(at) // size)
            row = np.repeat(np.arange(len(count)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * size
            length = np.minimum(np.diff(at)[row] - start, size)
            begin = at[row] + start
            blobs = [ids[a:b].tobytes() for a, b in
                     zip(begin.tolist(), (begin + length).tolist())]
            own = [batch.column("k").take(pa.array(row)), pa.array(piece.astype(np.int32)),
                   pa.array(start), pa.array(length),
                   pa.array([zlib.crc32(b) for b in blobs], pa.int64())]
            yield pa.RecordBatch.from_arrays(
                own + [pa.array(blobs, pa.binary())] * with_ids, names=columns)

    return picked.mapInArrow(run, f"k {dict(picked.dtypes)['k']}, piece int, start bigint, "
                             "length bigint, ids_crc32 bigint" + ", ids binary" * with_ids)


def patterns(cells: int) -> np.ndarray:
    """Multisets of one to three cells; pairs and triples fill a sequence exactly. -1 pads."""
    out = [(k, -1, -1) for k in range(1, cells + 1)]
    out += [(a, cells - a, -1) for a in range(1, cells // 2 + 1)]
    out += [(a, b, cells - a - b) for a in range(1, cells // 3 + 1)
            for b in range(a, (cells - a) // 2 + 1)]
    return np.array(out, np.int64)


def nnls(columns: np.ndarray, target: np.ndarray, weight: np.ndarray, rounds: int = 200,
         at_once: int = 12) -> np.ndarray:
    """Non-negative least squares for columns that are sums of unit vectors (active set).

    ``columns`` lists each column's rows (padded with -1). The best columns that share no
    row enter together; columns that turn negative leave.
    """
    n = len(target)
    padded = np.where(columns < 0, n, columns)
    x = np.zeros(len(columns))
    passive = np.zeros(len(columns), bool)
    rest = target.astype(np.float64)
    for _ in range(rounds):
        slope = np.append(weight ** 2 * rest, 0)[padded].sum(axis=1)
        slope[passive] = -1
        best = np.argsort(-slope)[:at_once * 40]
        taken: set[int] = set()
        entered = 0
        for c in best[slope[best] > 1e-6 * max(target.max(), 1)]:
            rows = set(columns[c][columns[c] >= 0].tolist())
            if not rows & taken:
                taken |= rows
                passive[c] = True
                entered += 1
            if entered == at_once:
                break
        if not entered:
            break
        while True:
            own = np.flatnonzero(passive)
            a = np.zeros((n + 1, len(own)))
            for place in padded[own].T:
                np.add.at(a, (place, np.arange(len(own))), 1)
            a = a[:n] * weight[:, None]
            gram = a.T @ a + 1e-9 * np.eye(len(own))
            z = np.linalg.solve(gram, a.T @ (weight * target))
            if (z > 0).all():
                break
            down = z <= 0
            step = np.min(np.where(down, x[own] / np.maximum(x[own] - z, 1e-30), np.inf))
            x[own] += min(step, 1.0) * (z - x[own])
            gone = own[down & (x[own] <= 1e-12)]
            passive[gone if len(gone) else own[down]] = False
            x[~passive] = 0
        x[:] = 0
        x[own] = z
        rest = target - np.bincount(padded[own].ravel(), weights=np.repeat(z, padded.shape[1]),
                                    minlength=n + 1)[:n]
    return x


def plan(histogram: dict[int, int], size: int = SIZE, unit: int = UNIT) -> list[tuple[tuple, int]]:
    """Patterns of exact lengths and their repeats, using every piece once."""
    left = Counter({k: v for k, v in histogram.items() if v > 0})
    out: list[tuple[tuple, int]] = []
    if left.get(size):
        out.append(((size,), left.pop(size)))
    cells = size // unit
    target = np.zeros(cells)
    for length, n in left.items():
        target[-(-length // unit) - 1] += n
    if target.any():
        grid = patterns(cells)
        # Long pieces have fewer places to go.
        weight = 0.1 + np.arange(1, cells + 1) / cells
        repeats = nnls(np.where(grid > 0, grid - 1, -1), target, weight)
        open_lengths = sorted(left)
        stock = defaultdict(list)
        for length in sorted(left):
            stock[-(-length // unit)].append(length)
        for c in np.argsort(-repeats, kind="stable"):
            if round(repeats[c]) < 1:
                break
            need = [int(k) for k in grid[c] if k > 0]
            if len(need) < 2:
                continue
            todo = round(repeats[c])
            while todo:
                # The longest lengths of the cells; the last cell (the longest of the
                # pattern) is matched exactly: the longest length that still fits.
                use, lengths = Counter(), []
                for k in need[:-1]:
                    pick = next((x for x in reversed(stock[k]) if left[x] > use[x]), None)
                    if pick is not None:
                        use[pick] += 1
                        lengths.append(pick)
                room = size - sum(lengths)
                at = bisect.bisect_right(open_lengths, room) - 1
                while at >= 0 and left[open_lengths[at]] <= use[open_lengths[at]]:
                    at -= 1
                if len(lengths) < len(need) - 1 or at < 0 or open_lengths[at] <= room - 2 * unit:
                    break
                use[open_lengths[at]] += 1
                lengths.append(open_lengths[at])
                n = min(todo, *(left[x] // m for x, m in use.items()))
                out.append((tuple(sorted(lengths, reverse=True)), n))
                todo -= n
                for x, m in use.items():
                    left[x] -= m * n
                    if not left[x]:
                        open_lengths.remove(x)
    return _repaired(_best_fit(out, {k: v for k, v in left.items() if v}, size), size)


def _repaired(planned: list[tuple[tuple, int]], size: int) -> list[tuple[tuple, int]]:
    """The plan with the fewest sequences among ``planned`` and what it becomes when sequences
    with more than each of ``ROOMS`` free are placed again, best fit. The last one frees all."""
    least = -(-sum(sum(content) * n for content, n in planned) // size)
    best, fewest = planned, sum(n for _, n in planned)
    for room in ROOMS:
        if fewest == least:
            break
        kept, freed = [], Counter()
        for content, n in planned:
            if size - sum(content) <= room:
                kept.append((content, n))
            else:
                for length in content:
                    freed[length] += n
        again = _best_fit(kept, freed, size)
        if sum(n for _, n in again) < fewest:
            best, fewest = again, sum(n for _, n in again)
    return best


def _best_fit(bins: list[tuple[tuple, int]], left: dict[int, int],
              size: int) -> list[tuple[tuple, int]]:
    """Place the left pieces, longest first, into the fullest sequences they fit into.

    Sequences with the same content are handled as one entry with a count.
    """
    space: dict[int, list[list]] = defaultdict(list)
    for content, n in bins:
        space[size - sum(content)].append([content, n])
    free = sorted(k for k in space if k)
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            at = bisect.bisect_left(free, length)
            if at == len(free):
                each = size // length
                full, rest = divmod(n, each)
                for m, count in ((each, full), (rest, 1 if rest else 0)):
                    if count:
                        _put(space, free, ((length,) * m, count), size)
                break
            room = free[at]
            content, count = space[room].pop()
            if not space[room]:
                del space[room]
                free.pop(at)
            # Several pieces may go into one sequence before a larger room is touched.
            used = min(n, count)
            _put(space, free, (content + (length,), used), size)
            if count > used:
                _put(space, free, (content, count - used), size)
            n -= used
    return [(c, n) for entries in space.values() for c, n in entries]


def _put(space, free, entry, size) -> None:
    room = size - sum(entry[0])
    if room and not space.get(room):
        bisect.insort(free, room)
    space[room].append(list(entry))


class Slots:
    """For each length, which sequence and offset its n-th piece gets."""

    def __init__(self, planned: list[tuple[tuple, int]]):
        rows, used, base = [], Counter(), 0
        for content, repeats in planned:
            offset = 0
            for length in content:
                rows.append((length, used[length], base, offset))
                used[length] += repeats
                offset += length
            base += repeats
        rows.sort()
        self.length, self.first, self.base, self.offset = (
            np.array(c, np.int64) for c in (zip(*rows) if rows else [()] * 4))
        self.lengths, self.at = np.unique(self.length, return_index=True)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = np.zeros(len(length), np.int64)
        for k in np.unique(length):
            own = length == k
            lo = self.at[np.searchsorted(self.lengths, k)]
            hi = np.searchsorted(self.length, k, "right")
            slot[own] = lo + np.searchsorted(self.first[lo:hi], rank[own], "right") - 1
        return self.base[slot] + rank - self.first[slot], self.offset[slot]


def place(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """``cut`` (staged pieces) with ``sequence_id`` and ``offset``.

    Pieces of one length are numbered within salted groups, whose offsets are running
    sums, so a length that a third of all pieces has is spread over many tasks.
    """
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    slots = Slots(plan(counts, size))
    salts = max(1, -(-sum(counts.values()) // SALT_ROWS)) * 8
    others = [c for c in cut.columns if c != "k"]
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("k", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = salted.groupBy("length", "salt").count().select(
        "length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "salt").orderBy("k", "piece", "ids_crc32")
    ranked = salted.withColumn("own", F.row_number().over(own)).join(
        offsets, ["length", "salt"]).select(
        "k", *others, (F.col("before") + F.col("own") - 1).alias("rank"))

    def run(batches):
        for batch in batches:
            sequence, offset = slots.find(batch.column("length").to_numpy(),
                                          batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ["k", *others]]
                + [pa.array(sequence), pa.array(offset)],
                names=["k", *others, "sequence_id", "offset"])

    types = dict(ranked.dtypes)
    return ranked.mapInArrow(run, ", ".join(
        [f"`{c}` {types[c]}" for c in ["k", *others]] + ["sequence_id bigint", "offset bigint"]))


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE,
         vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Every row of ``docs`` is packed, repeated ones each. A null or empty text is one piece
    that holds the end token, a text of any length as many pieces as it fills. Pieces of equal
    length are dealt in the order of a hash, then key and piece. Other columns are not read,
    whatever they are called. An empty table gives no piece.
    """
    cut = staged(pieces(docs, key, text, size, vocabulary, with_ids), "packing")
    return place(cut, size).withColumnRenamed("k", key)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id and the ids (of ``pack`` with ids)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``size`` pieces
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.array_join(
            F.transform("parts", lambda p: F.hex(p["ids"])), "").alias("hex")).select(
        "sequence_id", F.unhex("hex").alias("ids"))
