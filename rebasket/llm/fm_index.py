"""A full-text index of word numbers in numpy: backward search and location."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """The suffixes of ``symbols`` in order, by prefix doubling; the last symbol is the only 0."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    step = 1
    order = np.argsort(rank, kind="stable")
    while True:
        following = np.zeros(n, np.int64)
        following[:-step] = rank[step:] + 1 if step < n else following[:-step]
        key = rank * (n + 1) + following
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.zeros(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        rank = new
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Counts of a symbol before a position, one bit level after the other."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits = bits
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def descend(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Where ``position`` lies on the last level, following the bits of ``symbol``."""
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbol >> (self.bits - 1 - k)) & 1
            before = ones[position]
            position = np.where(bit == 1, zeros + before, position - before)
        return position

    def access(self, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at positions, and where these lie on the last level."""
        symbol = np.zeros(len(position), np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            before = ones[position]
            bit = ones[position + 1] - before
            symbol = symbol * 2 + bit
            position = np.where(bit == 1, zeros + before, position - before)
        return symbol, position


class FmIndex:
    """Burrows-Wheeler text of ``symbols`` (the last one the only 0) with ranks and samples."""

    SAMPLE = 8

    def __init__(self, symbols: np.ndarray, alphabet: int):
        order = suffix_order(symbols)
        last = symbols[order - 1]
        self.size = len(symbols)
        self.ranks = WaveletMatrix(last, max(int(alphabet - 1).bit_length(), 1))
        counts = np.bincount(symbols, minlength=alphabet)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        # Of the last level: where each symbol's block begins.
        self.block = self.ranks.descend(np.arange(alphabet), np.zeros(alphabet, np.int64))
        sampled = order % self.SAMPLE == 0
        self.sampled = np.concatenate(([0], np.cumsum(sampled)))
        self.positions = order[sampled]

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        return self.ranks.descend(symbol, position) - self.block[symbol]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each row of ``patterns`` (right-aligned).

        All patterns go backwards together, one symbol a step.
        """
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.size, np.int64)
        width = patterns.shape[1]
        for k in range(1, width + 1):
            live = np.flatnonzero((lengths >= k) & (low < high))
            if not len(live):
                continue
            symbol = patterns[live, width - k]
            low[live] = self.first[symbol] + self.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.rank(symbol, high[live])
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: steps back to the next sampled position."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        found = np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            at = rows[open_]
            hit = self.sampled[at + 1] > self.sampled[at]
            done = open_[hit]
            found[done] = self.positions[self.sampled[rows[done]]] + steps[done]
            open_ = open_[~hit]
            symbol, low = self.ranks.access(rows[open_])
            rows[open_] = self.first[symbol] + low - self.block[symbol]
            steps[open_] += 1
        return found
