"""Words of whole texts as numpy arrays: one pass over the bytes of an Arrow batch.

Texts are handled a slice of rows at a time, so memory follows the slice (or the
longest single text), not the partition. Hashes have 64 bits; two different words
of a corpus of n words meet with a chance of about n^2 / 2^65.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BYTES = np.arange(256)

# Bytes that end a word, by word class.
BLANK = np.isin(_BYTES, [0x20, *range(0x09, 0x0E)])
# Letters a-z, digits and all of non-ASCII make words (texts are lower-cased before).
NOT_ALNUM = (_BYTES <= 0x2F) | ((_BYTES >= 0x3A) & (_BYTES <= 0x60)) | (
    (_BYTES >= 0x7B) & (_BYTES <= 0x7F))
NEWLINE = _BYTES == 0x0A
CONTINUATION = (_BYTES & 0xC0) == 0x80

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _P_INV)):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batches, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about ``most`` bytes of text; no row is split."""
    for batch in batches:
        size = np.cumsum(_length(batch.column(column)))
        at = 0
        while at < batch.num_rows:
            before = size[at - 1] if at else 0
            end = max(int(np.searchsorted(size, before + most, "right")), at + 1)
            yield batch.slice(at, end - at)
            at = end
    release()


def release() -> None:
    """Hand freed memory back to the system: Spark keeps Python workers from task to task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _length(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


@dataclass
class Texts:
    """The bytes of some texts, end to end; text r is ``data[at[r]:at[r + 1]]``. Null is empty."""

    data: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, column: pa.Array, lower: bool = False) -> Texts:
        column = pc.fill_null(column, "").cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[
            column.offset:column.offset + len(column) + 1]
        buffer = column.buffers()[2]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
        data = data[offsets[0]:offsets[-1]]
        return cls(_LOWER[data] if lower else data, offsets - offsets[0])

    def sums(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text the mask marks."""
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[self.at[1:]] - total[self.at[:-1]]

    def words(self, ends: np.ndarray = BLANK) -> Words:
        inside = ~ends[self.data]
        n = len(inside)
        edge = np.zeros(n + 1, bool)
        edge[self.at] = True
        before = np.zeros(n + 1, bool)
        before[1:] = inside
        after = np.zeros(n + 1, bool)
        after[:n] = inside
        start = np.flatnonzero(after & (~before | edge))
        end = np.flatnonzero(before & (~after | edge))
        return Words(self, start, end, np.searchsorted(start, self.at))


@dataclass
class Words:
    """Word k is ``data[start[k]:end[k]]``; text r has words ``first[r]`` to ``first[r + 1]``."""

    texts: Texts
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, most: int = 1 << 19) -> np.ndarray:
        """64-bit hash of each word: a polynomial of its bytes, scrambled."""
        out = np.empty(len(self.start), np.uint64)
        at = 0
        while at < len(out):
            stop = max(int(np.searchsorted(self.end, self.start[at] + most, "right")), at + 1)
            lo, hi = int(self.start[at]), int(self.end[stop - 1])
            up, down = _pow(hi - lo)
            total = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum((self.texts.data[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:hi - lo],
                      out=total[1:])
            a, b = self.start[at:stop] - lo, self.end[at:stop] - lo
            out[at:stop] = (total[b] - total[a]) * down[a]
            at = stop
        return mix(out)

    def strings(self) -> list[bytes]:
        data = self.texts.data.tobytes()
        return [data[a:b] for a, b in zip(self.start.tolist(), self.end.tolist())]


def windows(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every run of ``size`` words that stays within a text."""
    if len(hashes) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    last = len(hashes) - size + 1
    joined = np.zeros(last, np.uint64)
    for k in range(size):
        joined = joined * _P + hashes[k:last + k]
    inside = rows[:last] == rows[size - 1:]
    return np.flatnonzero(inside), mix(joined[inside])


def joined(hashes: np.ndarray) -> int:
    """Hash of a whole short sequence, as ``windows`` hashes one of that size."""
    value = np.zeros(1, np.uint64)
    for h in hashes:
        value = value * _P + h
    return int(mix(value)[0])
