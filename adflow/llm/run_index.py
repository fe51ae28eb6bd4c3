"""Run-length compressed FM-index with matching statistics against earlier owners (numpy)."""

from __future__ import annotations

import numpy as np

from adflow.llm.fm_index import Wavelet

_BLOCK = 16


class RangeMin:
    """Least value of ranges: prefix and suffix minima of blocks, doubling tables over blocks."""

    def __init__(self, values: np.ndarray):
        pad = -len(values) % _BLOCK or _BLOCK
        high = np.iinfo(values.dtype).max
        blocks = np.append(values, np.full(pad, high, values.dtype)).reshape(-1, _BLOCK)
        self.flat = blocks.ravel()
        self.up = np.minimum.accumulate(blocks, axis=1).ravel()
        self.down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [blocks.min(axis=1)]
        while len(self.levels[-1]) > 1 << len(self.levels):
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last, np.append(last[step:], np.full(step, high))))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The least of values[lo:hi], for hi > lo."""
        end = hi - 1
        a, b = lo // _BLOCK, end // _BLOCK
        out = np.minimum(self.down[lo], self.up[end])
        one = np.flatnonzero(a == b)
        if len(one):
            x, last = lo[one], end[one]
            out[one] = self.flat[x]
            for k in range(1, _BLOCK):
                out[one] = np.minimum(out[one], self.flat[np.minimum(x + k, last)])
        many = np.flatnonzero(b - a > 1)
        if len(many):
            x, n = a[many] + 1, b[many] - a[many] - 1
            level = np.frexp(n.astype(float))[1] - 1
            for k in np.unique(level).tolist():
                own = level == k
                p, table = x[own], self.levels[k]
                at = many[own]
                out[at] = np.minimum(out[at], np.minimum(table[p], table[p + n[own] - (1 << k)]))
        return out


class RunIndex:
    """Index of pieces: runs of symbols >= 1, each with an owner (a number).

    The last column of the sorted suffixes is kept by its runs: their symbols in a wavelet
    matrix, their starts, and their summed lengths per symbol. Every piece ends in a mark of
    its own (0 in the wavelet), so suffixes differ within a piece's length and a few
    doublings sort them in full.
    """

    def __init__(self, symbols: np.ndarray, cut: np.ndarray, owner: np.ndarray):
        pieces = len(cut) - 1
        size = np.diff(cut)
        n = self.size = len(symbols) + pieces
        text = np.empty(n, np.int64)
        mark = cut[1:] + np.arange(pieces)
        inside = np.ones(n, bool)
        inside[mark] = False
        text[mark], text[inside] = np.arange(pieces), symbols + pieces
        order = self._sorted(text, int(size.max(initial=0)) + 1)
        plain = np.zeros(n, np.int64)
        plain[inside] = symbols
        last = plain[order - 1]
        start = np.flatnonzero(np.append(True, last[1:] != last[:-1])) if n else order
        heads, length = last[start], np.diff(np.append(start, n))
        self.start = start
        self.heads = heads
        self.width = max(int(plain.max(initial=0)).bit_length(), 1)
        self.wavelet = Wavelet(heads, self.width)
        by = np.argsort(heads, kind="stable")
        self.summed = np.concatenate([[0], np.cumsum(length[by])])
        self.first_run = np.concatenate([[0], np.cumsum(np.bincount(heads, minlength=1))])
        self.firsts = np.concatenate([[0], np.cumsum(np.bincount(plain, minlength=1))])
        whose = np.repeat(owner, size + 1).astype(np.int32)
        self.owner = RangeMin(whose[order])

    @staticmethod
    def _sorted(text: np.ndarray, longest: int) -> np.ndarray:
        n = len(text)
        rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
        order, span = np.argsort(rank, kind="stable"), 1
        while span < longest:
            behind = np.zeros(n, np.int64)
            behind[:max(n - span, 0)] = rank[span:] + 1
            key = rank * (n + 1) + behind
            order = np.argsort(key, kind="stable")
            rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            span *= 2
        return order

    def _before(self, symbol: np.ndarray, i: np.ndarray, run: np.ndarray, runs: np.ndarray):
        """How often the symbol is among the first i, given its runs before run ``run``."""
        base = self.first_run[symbol]
        inside = np.where(self.heads[run] == symbol, i - self.start[run], 0)
        return self.summed[base + runs] - self.summed[base] + inside

    def extended(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """Suffix ranges [lo, hi) of matches with the symbol put before them."""
        a = np.searchsorted(self.start, lo, "right") - 1
        b = np.searchsorted(self.start, hi, "right") - 1
        p, q = self.wavelet.rank(symbol, a, b)
        first = self.firsts[symbol]
        return (first + self._before(symbol, lo, a, p), first + self._before(symbol, hi, b, q))

    def matches(self, symbols: np.ndarray, cut: np.ndarray, owner: np.ndarray,
                least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Piece, start and end of stretches of at least ``least`` symbols that pieces of a
        smaller owner have too; every window of ``least`` symbols of such kind is in one.

        For an end place the match is extended backward while some smaller owner has it:
        the matching statistic of that end. Past the place that broke it, no window that holds
        that place can reach the end again; so the next end is the last one that a window
        from that place reaches, or the one before.
        """
        size = np.diff(cut)
        live = np.flatnonzero(size >= least)
        end = size[live] - 1
        at = end.copy()
        lo, hi = np.zeros(len(live), np.int64), np.full(len(live), self.size, np.int64)
        out: list[tuple] = []
        while len(live):
            symbol = symbols[cut[live] + at]
            a, b = self.extended(symbol, lo, hi)
            ok = a < b
            known = np.flatnonzero(ok)
            ok[known] = self.owner.least(a[known], b[known]) < owner[live[known]]
            lo, hi = np.where(ok, a, lo), np.where(ok, b, hi)
            at = np.where(ok, at - 1, at)
            # A match ends at a break or at the piece's start.
            done = ~ok | (at < 0)
            good = done & (end - at >= least)
            out.append((live[good], at[good] + 1, end[good] + 1))
            end = np.where(done, np.minimum(end - 1, at + least - 1), end)
            at = np.where(done, end, at)
            lo, hi = np.where(done, 0, lo), np.where(done, self.size, hi)
            keep = end >= least - 1
            live, end, at, lo, hi = live[keep], end[keep], at[keep], lo[keep], hi[keep]
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (live, live, live)
