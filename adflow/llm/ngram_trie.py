"""Two-level n-gram trie in Elias-Fano sequences over memory-mapped files, in numpy."""

from __future__ import annotations

import os

import numpy as np

WORD_BITS = 24
EXACT = 128
STEPS = 6  # quantised counts per doubling, above EXACT


def quantised(count: np.ndarray) -> np.ndarray:
    """One byte per count: exact below 128, then six steps per doubling. 0 is 0."""
    high = EXACT + np.round(STEPS * np.log2(np.maximum(count, EXACT) / EXACT))
    return np.where(count < EXACT, count, np.minimum(high, 255)).astype(np.uint8)


def restored(code: np.ndarray) -> np.ndarray:
    high = EXACT * 2.0 ** ((code.astype(np.float64) - EXACT) / STEPS)
    return np.where(code < EXACT, code, high)


def _mapped(array: np.ndarray, folder: str | None, name: str) -> np.ndarray:
    if folder is None or not array.nbytes:
        return array
    path = os.path.join(folder, name)
    array.tofile(path)
    return np.memmap(path, array.dtype, "r", shape=array.shape)


class EliasFano:
    """A non-decreasing sequence: low bits packed, high parts as a bit vector."""

    def __init__(self, values: np.ndarray, folder: str | None = None, name: str = "ef"):
        self.size = n = len(values)
        top = int(values[-1]) if n else 0
        self.low_bits = max(((top + 1) // max(n, 1)).bit_length() - 1, 0)
        width = self.low_bits
        values = values.astype(np.uint64)
        self.mask = np.uint64((1 << width) - 1)
        low = np.zeros(n * width // 64 + 2, np.uint64)
        if width and n:
            at = np.arange(n, dtype=np.int64) * width
            part = values & self.mask
            shift = (at & 63).astype(np.uint64)
            np.bitwise_or.at(low, at >> 6, part << shift)
            over = (at & 63) + width > 64
            np.bitwise_or.at(low, (at[over] >> 6) + 1,
                             part[over] >> (np.uint64(64) - shift[over]))
        place = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros((n + (top >> width)) // 64 + 2, np.uint64)
        np.bitwise_or.at(bits, place >> 6, np.uint64(1) << (place & 63).astype(np.uint64))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])
        self.low = _mapped(low, folder, f"{name}.low")
        self.high = _mapped(bits, folder, f"{name}.high")
        self.ones = _mapped(ones, folder, f"{name}.ones")
        self.zeros = _mapped(64 * np.arange(len(ones)) - ones, folder, f"{name}.zeros")
        self.buckets = top >> width

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        shift = (at & 63).astype(np.uint64)
        first = self.low[at >> 6] >> shift
        # A shift by 64 is not defined, so the next word is moved in two steps.
        second = (self.low[(at >> 6) + 1] << (np.uint64(63) - shift)) << np.uint64(1)
        return (first | second) & self.mask

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the k-th one or zero of the high bits (from 0)."""
        ahead = self.ones if one else self.zeros
        word = np.searchsorted(ahead, k, "right") - 1
        left = k - ahead[word]
        bits = self.high[word] if one else ~self.high[word]
        at = word << 6
        for width in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            far = left >= count
            left = left - np.where(far, count, 0)
            bits = np.where(far, bits >> np.uint64(width), bits)
            at = at + np.where(far, width, 0)
        return at

    def get(self, i: np.ndarray) -> np.ndarray:
        high = (self._select(i, True) - i).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._lows(i)

    def successor(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Index in [lo, hi) of the first value >= x that shares its high part, else the end
        of that part. Reading there tells whether x is present."""
        high = (x >> np.uint64(self.low_bits)).astype(np.int64)
        known = high <= self.buckets
        part = np.where(known, high, 0)
        begin = np.where(part > 0, self._select(np.maximum(part - 1, 0), False) + 1 - part, 0)
        end = self._select(part, False) - part
        a = np.where(known, np.maximum(begin, lo), hi)
        b = np.where(known, np.minimum(end, hi), hi)
        want = x & self.mask
        while (open_ := a < b).any():
            live = np.flatnonzero(open_)
            middle = (a[live] + b[live]) >> 1
            less = self._lows(middle) < want[live]
            a[live] = np.where(less, middle + 1, a[live])
            b[live] = np.where(less, b[live], middle)
        return a

    def find(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Index of x in [lo, hi), or -1."""
        at = self.successor(x, lo, hi)
        inside = np.flatnonzero(at < hi)
        out = np.full(len(x), -1, np.int64)
        same = self.get(at[inside]) == x[inside]
        out[inside[same]] = at[inside[same]]
        return out


class Trie:
    """Contexts, and under each the words that follow it with a quantised count.

    A word is stored relative to its context: the context's number is put before it, so the
    level as a whole does not decrease and a search stays inside the context's range.
    """

    def __init__(self, context: np.ndarray, word: np.ndarray, count: np.ndarray,
                 folder: str | None = None):
        own, start, number = np.unique(context, return_index=True, return_inverse=True)
        self.size = len(word)
        if self.size:
            self.contexts = EliasFano(own, folder, "contexts")
            self.pointers = EliasFano(np.append(start, len(word)), folder, "pointers")
            relative = (number.astype(np.uint64) << np.uint64(WORD_BITS)) | word.astype(np.uint64)
            self.words = EliasFano(relative, folder, "words")
            self.codes = _mapped(quantised(count), folder, "codes")

    def lookup(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Quantised counts; 0 where the trie does not have the n-gram."""
        out = np.zeros(len(context), np.uint8)
        if not self.size or not len(context):
            return out
        whole = np.zeros(len(context), np.int64)
        number = self.contexts.find(context.astype(np.uint64), whole, whole + self.contexts.size)
        known = np.flatnonzero(number >= 0)
        number = number[known]
        lo = self.pointers.get(number).astype(np.int64)
        hi = self.pointers.get(number + 1).astype(np.int64)
        relative = (number.astype(np.uint64) << np.uint64(WORD_BITS)) | (
            word[known].astype(np.uint64))
        at = self.words.find(relative, lo, hi)
        out[known[at >= 0]] = self.codes[at[at >= 0]]
        return out
