"""Re-Pair grammars and the runs in them, for the texts of a slice at once (numpy).

A grammar is built per text: a pair of neighbouring symbols that occurs twice or more is
replaced by a new symbol. Each round replaces, in all texts together, every pair that is
more frequent than the pairs it overlaps with; so the most frequent pair of each text always
goes first, and pairs that do not touch do not wait for each other.

A replaced occurrence stays in the derivation tree, so the places where a symbol was put are
all its derivation positions. What no rule covers is bound by a balanced tree of pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAST = 12      # words of the shortest run
GRAM = 4        # words that a run must repeat next to a boundary
AT_ONCE = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Rules:
    """Nonterminal x derives the words ``at[x]`` to ``at[x] + size[x]``; its halves meet
    ``left[x]`` words in. ``of`` and ``places`` list every derivation: symbol and word."""

    at: np.ndarray
    size: np.ndarray
    left: np.ndarray
    of: np.ndarray
    places: np.ndarray


def _ends(first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The end of the text that each word is in."""
    return first[np.searchsorted(first, at, "right")]


def repair(symbols: np.ndarray, first: np.ndarray) -> Rules:
    """Rules for texts of ``symbols`` (different numbers in different texts) that start at
    ``first`` (the last entry is the end)."""
    n = len(symbols)
    at, seq = np.arange(n), symbols.astype(np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    new = int(seq.max()) + 1 if n else 1
    ends = np.append(at[1:], n)
    rules: list[tuple] = []
    open_ = np.ones(n, bool)  # whether the pair that starts here may repeat
    while len(seq) > 1:
        same = text[1:] == text[:-1]
        # In a stretch of equal symbols every second pair counts: pairs must not overlap.
        equal = (seq[1:] == seq[:-1]) & same
        k = np.arange(len(equal))
        begin = np.maximum.accumulate(np.where(equal & ~np.append(False, equal[:-1]), k, 0))
        usable = same & open_[:-1] & ~(equal & ((k - begin) % 2 == 1))
        who = np.flatnonzero(usable)
        if not len(who):
            break
        _, name, count = np.unique(
            seq[who] * np.int64(new) + seq[who + 1] if new < 1 << 31 else _pairs(seq, who),
            return_inverse=True, return_counts=True)
        open_ = np.zeros(len(seq), bool)
        twice = count[name] > 1
        if not twice.any():
            break
        who, name = who[twice], name[twice]
        open_[who] = True
        rank = np.full(len(seq) + 1, -1, np.int64)  # one spare in front
        rank[who + 1] = count[name] * np.int64(len(count) + 1) + name
        own = rank[who + 1]
        wins = (own > rank[who]) & (own > rank[np.minimum(who + 2, len(seq))])
        chosen = np.bincount(name[wins], minlength=len(count))
        wins &= chosen[name] > 1
        if not wins.any():
            break
        who, name = who[wins], name[wins]
        pairs, rule = np.unique(name, return_inverse=True)
        lead = np.full(len(pairs), len(seq), np.int64)
        np.minimum.at(lead, rule, who)
        rules.append((at[lead], ends[lead + 1] - at[lead], at[lead + 1] - at[lead], rule, at[who]))
        seq[who], ends[who] = new + rule, ends[who + 1]
        new += len(pairs)
        # A new symbol makes new pairs on both sides; all other pairs can only get rarer.
        open_[who] = True
        open_[np.maximum(who - 1, 0)] = True
        gone = who + 1
        last = gone[gone + 1 <= len(seq) - 1]
        keep = np.ones(len(seq), bool)
        keep[gone] = False
        open_[last - 1] = True
        seq, text, at, ends, open_ = seq[keep], text[keep], at[keep], ends[keep], open_[keep]
    base, out = 0, [[], [], [], [], []]
    for rule in rules:
        for k in range(5):
            out[k].append(rule[k] + base if k == 3 else rule[k])
        base += len(rule[0])
    # What is left of each text, bound pair by pair in a balanced tree.
    while True:
        edge = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else text
        place = np.arange(len(text)) - np.repeat(edge, np.diff(np.append(edge, len(text))))
        who = np.flatnonzero((place[:-1] % 2 == 0) & (text[1:] == text[:-1]))
        if not len(who):
            break
        out[0].append(at[who])
        out[1].append(ends[who + 1] - at[who])
        out[2].append(at[who + 1] - at[who])
        out[3].append(base + np.arange(len(who)))
        out[4].append(at[who])
        base += len(who)
        ends[who] = ends[who + 1]
        keep = np.ones(len(text), bool)
        keep[who + 1] = False
        text, at, ends = text[keep], at[keep], ends[keep]
    return Rules(*(np.concatenate(x or [np.zeros(0, np.int64)]) for x in out))


def _pairs(seq: np.ndarray, who: np.ndarray) -> np.ndarray:
    """Numbers of pairs where symbols are too large to share 64 bits."""
    pairs = np.stack([seq[who], seq[who + 1]], axis=1)
    return np.unique(pairs, axis=0, return_inverse=True)[1].ravel()


class _Match:
    """How far two places of the text agree, by hashes of whole powers of two."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.total = np.zeros(n + 1, np.uint64)
        self.power = np.ones(n + 2, np.uint64)
        self.power[1:] = _BASE
        self.power = np.multiply.accumulate(self.power)
        inverse = np.full(n + 2, pow(int(_BASE), -1, 1 << 64), np.uint64)
        inverse[0] = 1
        self.inverse = np.multiply.accumulate(inverse)
        np.cumsum(symbols * self.power[:n], out=self.total[1:])

    def _same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the words from a and from b (a < b) agree for that size."""
        x = (self.total[a + size] - self.total[a]) * self.power[b - a]
        return x == self.total[b + size] - self.total[b]

    def right(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words that agree from a and b (a < b) on."""
        return self._grow(a, b, most, False)

    def left(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words that agree up to and with a and b (a < b)."""
        return self._grow(a, b, most, True)

    def _grow(self, a, b, most, back: bool) -> np.ndarray:
        done = np.zeros(len(a), np.int64)
        if not len(a):
            return done
        for level in range(int(most.max()).bit_length() - 1, -1, -1):
            step = np.int64(1 << level)
            fits = np.flatnonzero(done + step <= most)
            if back:
                x, y = a[fits] - done[fits] - step + 1, b[fits] - done[fits] - step + 1
            else:
                x, y = a[fits] + done[fits], b[fits] + done[fits]
            done[fits] += np.where(self._same(x, y, step), step, 0)
        return done


def _grams(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A number for each run of ``GRAM`` words within a text; -1 where none starts."""
    n = len(symbols)
    name = np.full(n, -1, np.int64)
    if n < GRAM:
        return name
    value = np.zeros(n - GRAM + 1, np.uint64)
    for k in range(GRAM):
        value = (value ^ (value >> np.uint64(29))) * _BASE + symbols[k:n - GRAM + 1 + k].astype(np.uint64)
    at = np.arange(n - GRAM + 1)
    inside = at + GRAM <= _ends(first, at)
    name[:len(at)][inside] = np.unique(value[inside], return_inverse=True)[1]
    return name


def runs(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (word of the slice), length and smallest period of every run of the texts.

    Every run lies in the nonterminal that is the lowest to hold all of it, and crosses the
    boundary of that one's halves. So the runs that cross a boundary within what its
    nonterminal derives are computed once per nonterminal, with every period, and moved to all
    places where it derives; what a lower nonterminal sees of a longer run lies within the
    run that a higher one sees.
    """
    none = np.zeros(0, np.int64)
    rules = repair(symbols, first)
    symbols = symbols.astype(np.uint64)
    long = np.flatnonzero(rules.size >= LEAST)
    if not len(long):
        return none, none, none
    grams = _grams(symbols, first)
    by = np.lexsort((np.arange(len(grams)), grams))
    by = by[np.searchsorted(grams[by], 0):]
    span = np.int64(len(grams) + 1)
    key = grams[by] * span + by
    match = _Match(symbols)
    found = []
    lo, size, split = rules.at[long], rules.size[long], rules.at[long] + rules.left[long]
    hi = lo + size
    # Next to the boundary b, a run with period q has GRAM words that come again q words
    # away: those from b or from b - 3 also to the left, or those from b - 1 or b - 4 to the right.
    for shift, right in ((0, False), (-(GRAM - 1), False), (-1, True), (-GRAM, True)):
        here = split + shift
        ok = np.flatnonzero((here >= lo) & (here + GRAM <= hi))
        ok = ok[grams[here[ok]] >= 0]
        base = grams[here[ok]] * span
        if right:
            a = np.searchsorted(key, base + here[ok] + 1)
            b = np.searchsorted(key, base + hi[ok] - GRAM + 1)
        else:
            a = np.searchsorted(key, base + lo[ok])
            b = np.searchsorted(key, base + here[ok])
        count = np.maximum(b - a, 0)
        total = np.concatenate([[0], np.cumsum(count)])
        for at in range(0, int(total[-1]), AT_ONCE):
            flat = np.arange(at, min(at + AT_ONCE, int(total[-1])))
            own = np.searchsorted(total, flat, "right") - 1
            other = by[a[own] + flat - total[own]]
            x = ok[own]
            lag = np.abs(other - here[x])
            # t and t + lag are the same word, next to the boundary.
            t = split[x] - 1 if right else split[x] - lag
            fits = (t >= lo[x]) & (t + lag < hi[x])
            x, lag, t = x[fits], lag[fits], t[fits]
            after = match.right(t, t + lag, hi[x] - lag - t)
            before = match.left(t, t + lag, t - lo[x] + 1)
            same = after + before - 1
            good = (after > 0) & (same + lag >= LEAST) & (same >= lag)
            x, lag = x[good], lag[good]
            start, length = (t - before + 1)[good], same[good] + lag
            # Several periods of one stretch are multiples of the smallest.
            order = np.lexsort((lag, length, start, x))
            x, start, length, lag = (v[order] for v in (x, start, length, lag))
            lead = np.ones(len(x), bool)
            lead[1:] = (x[1:] != x[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
            found.append([v[lead] for v in (x, start, length, lag)])
    x, start, length, lag = (np.concatenate(v) for v in zip(*found)) if found else [none] * 4
    order = np.lexsort((lag, length, start, x))
    x, start, length, lag = (v[order] for v in (x, start, length, lag))
    lead = np.ones(len(x), bool)
    lead[1:] = (x[1:] != x[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    x, start, length, lag = (v[lead] for v in (x, start, length, lag))
    if not len(x):
        return none, none, none
    # To every place where the nonterminal derives.
    by = np.argsort(rules.of, kind="stable")
    of, places = rules.of[by], rules.places[by]
    a, b = np.searchsorted(of, long[x]), np.searchsorted(of, long[x], "right")
    count = b - a
    run = np.repeat(np.arange(len(x)), count)
    put = places[np.repeat(a - np.cumsum(count) + count, count) + np.arange(int(count.sum()))]
    start, length, lag = start[run] - lo[x[run]] + put, length[run], lag[run]
    return _maximal(start, length, lag)


def _maximal(start: np.ndarray, length: np.ndarray, period: np.ndarray):
    """Without intervals that lie in another one of the same period, and without multiples of
    a period of the same interval; by start, then period."""
    order = np.lexsort((-length, start, period))
    start, length, period = start[order], length[order], period[order]
    end = start + length
    # The furthest end before each row, among rows of its period.
    step = np.int64(end.max() + 1)
    group = np.cumsum(np.append(False, period[1:] != period[:-1]))
    reach = np.maximum.accumulate(end + group * step)
    keep = np.ones(len(start), bool)
    keep[1:] = (group[1:] != group[:-1]) | (end[1:] + group[1:] * step > reach[:-1])
    start, length, period = start[keep], length[keep], period[keep]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    lead = np.ones(len(start), bool)
    lead[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[lead], length[lead], period[lead]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]
