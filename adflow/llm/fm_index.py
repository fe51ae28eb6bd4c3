"""FM-index over word symbols in numpy: backward search by wavelet ranks, located by samples."""

from __future__ import annotations

import numpy as np

SAMPLE = 8
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class Bits:
    """A bit vector with rank: whole bytes are counted ahead, one every 8 bytes."""

    def __init__(self, bits: np.ndarray):
        self.size = len(bits)
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(packed) // 8 * 8 + 16, np.uint8)
        self.words[:len(packed)] = packed
        ones = _POP[self.words].reshape(-1, 8).sum(axis=1, dtype=np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])
        self.words = self.words.view(np.uint64)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class Wavelet:
    """Wavelet matrix: one bit vector per symbol bit, zeros before ones at each level."""

    def __init__(self, symbols: np.ndarray, width: int):
        self.levels: list[tuple[Bits, int]] = []
        self.width = width
        for level in range(width - 1, -1, -1):
            bit = ((symbols >> level) & 1).astype(bool)
            self.levels.append((Bits(bit), int(len(bit) - bit.sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """How often each symbol is among the first lo and the first hi symbols, from the
        place where the symbol's run starts in the last level."""
        start = np.zeros(len(symbol), np.int64)
        for k, (bits, zeros) in enumerate(self.levels):
            one = ((symbol >> (self.width - 1 - k)) & 1).astype(bool)
            ranks = [bits.rank(x) for x in (start, lo, hi)]
            start, lo, hi = (
                np.where(one, zeros + r, x - r) for x, r in zip((start, lo, hi), ranks))
        return lo - start, hi - start

    def get(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it comes before that place."""
        start, at = np.zeros(len(i), np.int64), i
        symbol = np.zeros(len(i), np.int64)
        for bits, zeros in self.levels:
            one = bits.get(at).astype(bool)
            symbol = symbol * 2 + one
            start, at = (np.where(one, zeros + bits.rank(x), x - bits.rank(x))
                         for x in (start, at))
        return symbol, at - start


class FMIndex:
    """Index of a sequence of symbols >= 1. Suffixes are sorted in full, by doubling."""

    def __init__(self, symbols: np.ndarray):
        text = np.append(symbols.astype(np.int64), 0)
        n = self.size = len(text)
        rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
        order, span = np.argsort(rank, kind="stable"), 1
        while rank[order[-1]] < n - 1:
            behind = np.zeros(n, np.int64)
            behind[:max(n - span, 0)] = rank[span:] + 1
            key = rank * (n + 1) + behind
            order = np.argsort(key, kind="stable")
            rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            span *= 2
        self.width = max(int(text.max()).bit_length(), 1)
        self.wavelet = Wavelet(text[order - 1], self.width)
        self.firsts = np.concatenate([[0], np.cumsum(np.bincount(text))])
        marked = order % SAMPLE == 0
        self.marked, self.samples = Bits(marked), order[marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of the phrases, rows of symbols padded on the right."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.size, np.int64)
        known = np.ones(len(phrases), bool)
        for k in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((k < lengths) & known & (lo < hi))
            if not len(live):
                continue
            symbol = phrases[live, k]
            absent = (symbol < 1) | (symbol >= len(self.firsts) - 1)
            known[live[absent]] = False
            live, symbol = live[~absent], symbol[~absent]
            a, b = self.wavelet.rank(symbol, lo[live], hi[live])
            lo[live], hi[live] = self.firsts[symbol] + a, self.firsts[symbol] + b
        return lo, np.where(known, hi, lo)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix row: walk back to a sampled suffix."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        out = np.full(len(rows), -1, np.int64)
        live = np.arange(len(rows))
        while len(live):
            here = self.marked.get(at[live]).astype(bool)
            done = live[here]
            out[done] = self.samples[self.marked.rank(at[done])] + steps[done]
            live = live[~here]
            symbol, before = self.wavelet.get(at[live])
            at[live] = self.firsts[symbol] + before
            steps[live] += 1
        return out
