"""FM-index of a sequence of small integers: suffix array by prefix doubling,
Burrows-Wheeler column in a wavelet matrix, and sampled suffix positions."""

from __future__ import annotations

import numpy as np


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Order of all suffixes. Values at the ends of runs must be distinct, so
    that comparisons stop there."""
    n = len(seq)
    _, rank = np.unique(seq, return_inverse=True)
    rank = rank.astype(np.int64)
    k = 1
    while True:
        second = np.zeros(n, np.int64)
        second[: n - k] = rank[k:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, np.int64)
        ks = key[order]
        new[order[1:]] = np.cumsum(ks[1:] != ks[:-1])
        rank = new
        k *= 2
        if k >= n or rank[order[-1]] == n - 1:
            return order


class WaveletMatrix:
    """Ranks of a symbol in prefixes of a sequence, for arrays of questions."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (seq >> level) & 1
            ones = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(seq) - int(ones[-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbol: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
        """How often each symbol occurs before each end."""
        first = np.zeros(len(symbol), np.int64)
        ends = [e.astype(np.int64) for e in ends]
        for level, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros):
            up = (symbol >> level) & 1 == 1
            step = lambda i: np.where(up, zeros + ones[i], i - ones[i])
            first = step(first)
            ends = [step(e) for e in ends]
        return [e - first for e in ends]


class FMIndex:
    """Index of runs of symbols (each at least 1), one run after another.

    ``locate`` gives every place at which a pattern occurs. Patterns never
    cross from one run to the next.
    """

    SAMPLE = 8

    def __init__(self, symbols: np.ndarray, run_starts: np.ndarray, sigma: int):
        runs, n = len(run_starts), len(symbols)
        ends = np.append(run_starts[1:], n)
        lens = ends - run_starts
        size = n + runs  # each run gets an end mark of its own
        at = np.arange(n) + np.repeat(np.arange(runs), lens)
        marks = ends + np.arange(runs)
        seq = np.empty(size, np.int64)
        seq[at] = symbols + runs - 1
        seq[marks] = np.arange(runs)
        order = suffix_array(seq)
        plain = np.zeros(size, np.int64)
        plain[at] = symbols
        self.origin = np.full(size, -1, np.int64)
        self.origin[at] = np.arange(n)
        self.last = plain[order - 1]  # symbol before each suffix, 0: a mark
        self.tree = WaveletMatrix(self.last, sigma)
        counts = np.bincount(plain, minlength=sigma)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        sampled = order % self.SAMPLE == 0
        sampled[np.isin(order, np.append(run_starts + np.arange(runs), marks))] = True
        self.sampled = sampled
        self.position = order[sampled]  # only these suffix positions are kept
        self.before = np.cumsum(sampled) - sampled

    def ranges(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all patterns (rows, left-aligned) at once."""
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), len(self.last), np.int64)
        live = np.arange(len(patterns))
        for j in range(patterns.shape[1]):
            live = live[(hi[live] > lo[live]) & (lengths[live] > j)]
            if not len(live):
                break
            c = patterns[live, lengths[live] - 1 - j]
            a, b = self.tree.rank(c, lo[live], hi[live])
            lo[live], hi[live] = self.first[c] + a, self.first[c] + b
        return lo, np.maximum(lo, hi)

    def locate(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern number, place in the symbols) of every occurrence."""
        lo, hi = self.ranges(patterns, lengths)
        count = hi - lo
        who = np.repeat(np.arange(len(patterns)), count)
        row = np.arange(len(who)) + np.repeat(lo - np.cumsum(count) + count, count)
        steps = np.zeros(len(row), np.int64)
        walk = np.flatnonzero(~self.sampled[row])
        while len(walk):
            c = self.last[row[walk]]
            (r,) = self.tree.rank(c, row[walk])
            row[walk] = self.first[c] + r
            steps[walk] += 1
            walk = walk[~self.sampled[row[walk]]]
        return who, self.origin[self.position[self.before[row]] + steps]
