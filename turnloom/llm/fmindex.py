"""An FM-index over word numbers, in vectorised numpy: suffix sorting, wavelet matrix, backward search, locate.

Every query runs for whole arrays of patterns at once, so the Python overhead is per step, not per pattern.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; the text must end in a symbol that occurs nowhere else."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, h = len(text), 1
    order = np.argsort(rank, kind="stable")
    while True:
        top = int(rank.max()) + 1
        if top == n:
            return order
        second = np.full(n, 0, dtype=np.int64)
        second[: n - h] = rank[h:] + 1
        key = rank * (top + 1) + second
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        h *= 2


class WaveletMatrix:
    """Ranks and access over a sequence of small numbers, one bit plane per level."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        cur = seq
        for level in range(bits - 1, -1, -1):
            bit = (cur >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))))
            self.zeros.append(int(len(cur) - bit.sum()))
            cur = np.concatenate((cur[bit == 0], cur[bit == 1]))

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Occurrences of each ``symbol`` before position ``upto``."""
        start, end = np.zeros_like(upto), upto
        for k in range(self.bits):
            bit = (symbol >> (self.bits - 1 - k)) & 1
            ones, zeros = self.ones[k], self.zeros[k]
            s1, e1 = ones[start], ones[end]
            start = np.where(bit == 1, zeros + s1, start - s1)
            end = np.where(bit == 1, zeros + e1, end - e1)
        return end - start

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at each position and its rank before that position."""
        symbol, start = np.zeros_like(at), np.zeros_like(at)
        for k in range(self.bits):
            ones, zeros = self.ones[k], self.zeros[k]
            o = ones[at]
            bit = ones[at + 1] - o
            s = ones[start]
            start = np.where(bit == 1, zeros + s, start - s)
            at = np.where(bit == 1, zeros + o, at - o)
            symbol = (symbol << 1) | bit
        return symbol, at - start


class FMIndex:
    """Backward search over ``text`` (numbers below ``sigma``, the last one a 0 that occurs only there)."""

    def __init__(self, text: np.ndarray, sigma: int, sample: int = 4):
        order = suffix_array(text)
        n = len(text)
        self.n, self.sample = n, sample
        bwt = text[order - 1].astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma)))).astype(np.int64)
        self.wm = WaveletMatrix(bwt, max(1, int(sigma - 1).bit_length()))
        marked = order % sample == 0
        self.marks = np.concatenate(([0], np.cumsum(marked))).astype(np.int64)
        self.kept = order[marked]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals ``[lo, hi)`` of each pattern (one per row of ``patterns``)."""
        lo = np.zeros(len(patterns), dtype=np.int64)
        hi = np.full(len(patterns), self.n, dtype=np.int64)
        for k in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[:, k]
            lo = self.first[c] + self.wm.rank(c, lo)
            hi = self.first[c] + self.wm.rank(c, hi)
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back to the next sampled position."""
        out = np.empty(len(rows), dtype=np.int64)
        todo, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            hit = self.marks[at + 1] > self.marks[at]
            out[todo[hit]] = self.kept[self.marks[at[hit]]] + steps
            todo, at = todo[~hit], at[~hit]
            if len(todo):
                c, r = self.wm.access(at)
                at = self.first[c] + r
                steps += 1
        return out
