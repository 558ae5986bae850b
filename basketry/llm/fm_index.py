"""An FM-index over integer sequences, in numpy: wavelet matrix, sampled suffix positions.

One index holds one bounded shard. Suffixes are ordered by prefix doubling, so
a search is exact for phrases of any length.
"""

from __future__ import annotations

import numpy as np


def suffix_order(s: np.ndarray) -> np.ndarray:
    """Start positions in the order of their suffixes; the end of ``s`` sorts first."""
    rank, step = np.unique(s, return_inverse=True)[1].astype(np.int64), 1
    while True:
        after = np.full(len(s), -1, dtype=np.int64)
        after[:len(s) - step] = rank[step:]
        key = rank * (len(s) + 1) + after + 1
        order = np.argsort(key, kind="stable")
        fresh = np.empty(len(s), dtype=np.int64)
        ordered = key[order]
        fresh[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank, step = fresh, step * 2
        if rank[order[-1]] == len(s) - 1 or step >= len(s):
            return order


class WaveletMatrix:
    """Rank queries on an integer sequence, one bit vector with running counts per level."""

    def __init__(self, s: np.ndarray, bits: int):
        self.bits, self.zeros, self.ranks = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (s >> level & 1).astype(bool)
            self.ranks.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int64)]))
            self.zeros.append(int(len(s) - self.ranks[-1][-1]))
            s = np.concatenate([s[~bit], s[bit]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        low = np.zeros_like(at)
        for level, (zeros, ones) in enumerate(zip(self.zeros, self.ranks, strict=True)):
            bit = (symbol >> (self.bits - 1 - level) & 1).astype(bool)
            low = np.where(bit, zeros + ones[low], low - ones[low])
            at = np.where(bit, zeros + ones[at], at - ones[at])
        return at - low


class FMIndex:
    """Counts and places of phrases in ``s`` (symbols >= 1; 0 is kept for the end)."""

    def __init__(self, s: np.ndarray, symbols: int, sample: int = 16):
        s = np.concatenate([s.astype(np.int64), [0]])
        order = suffix_order(s)
        self.last = s[order - 1]
        self.tree = WaveletMatrix(self.last, max(1, int(symbols).bit_length()))
        counts = np.bincount(s, minlength=symbols + 2)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.sampled = order % sample == 0
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])
        self.places = order[self.sampled]

    def search(self, phrases: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Half-open suffix ranges of all phrases, by backward search side by side."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), len(self.last), dtype=np.int64)
        lengths = np.array([len(p) for p in phrases], dtype=np.int64)
        for k in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((lengths > k) & (low < high))
            if not len(live):
                break
            symbol = np.array([phrases[i][len(phrases[i]) - 1 - k] for i in live], dtype=np.int64)
            low[live] = self.before[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.tree.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back to the next sampled one."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), dtype=np.int64), np.full(len(rows), -1, dtype=np.int64)
        while True:
            hit = (out < 0) & self.sampled[rows]
            out[hit] = self.places[self.sample_rank[rows[hit]]] + steps[hit]
            left = np.flatnonzero(out < 0)
            if not len(left):
                return out
            symbol = self.last[rows[left]]
            rows[left] = self.before[symbol] + self.tree.rank(symbol, rows[left])
            steps[left] += 1
