"""An FM-index over a sequence of symbols: backward search by wavelet ranks, positions by suffix samples.

The sequence consists of runs of symbols 1..sigma-1, each run closed by a 0. Runs never match across
their ends, so every closing 0 counts as a symbol of its own when suffixes are sorted.
"""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 16
WORD_BITS = 64


class BitVector:
    """Bits packed in 64-bit words with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        padded = np.zeros((self.n // WORD_BITS + 1) * WORD_BITS, dtype=np.uint8)
        padded[: self.n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletTree:
    """Ranks of symbols in a sequence: one bit vector per bit of the symbols, zeros moved before ones."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels: list[tuple[int, BitVector, int]] = []
        current = symbols
        for bit in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            ones = (current >> bit) & 1 == 1
            self.levels.append((bit, BitVector(ones), int(len(ones) - ones.sum())))
            current = np.concatenate([current[~ones], current[ones]])
        everything = np.arange(sigma)
        self.start = self._descend(everything, np.zeros(sigma, dtype=np.int64))

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, vector, zeros in self.levels:
            ones = vector.rank(at)
            at = np.where((symbols >> bit) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        return self._descend(symbols, at) - self.start[symbols]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at the positions and how often each stands before its own."""
        symbols = np.zeros(len(at), dtype=np.int64)
        for bit, vector, zeros in self.levels:
            set_here, ones = vector.get(at), vector.rank(at)
            symbols |= set_here.astype(np.int64) << bit
            at = np.where(set_here, zeros + ones, at - ones)
        return symbols, at - self.start[symbols]


def suffix_array(sequence: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; each 0 ends its suffix and ranks by position."""
    n = len(sequence)
    ends = np.flatnonzero(sequence == 0)
    rank = sequence.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    length = 1
    while True:
        follow = np.zeros(n, dtype=np.int64)
        follow[: n - length] = rank[length:] + 1
        key = rank * (int(rank.max()) + 2) + follow
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        place = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = place
        length *= 2
        if place[-1] == n - 1 or length >= n:
            return order


class FMIndex:
    """Search structure over ``sequence`` (see the module) with symbols below ``sigma``."""

    def __init__(self, sequence: np.ndarray, sigma: int):
        self.n, self.sigma = len(sequence), sigma
        order = suffix_array(sequence)
        self.tree = WaveletTree(sequence[order - 1].astype(np.int64), sigma)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=sigma))])
        positions = np.arange(self.n)
        ends = np.flatnonzero(sequence == 0)
        run_start = np.concatenate([[0], ends + 1])[np.searchsorted(ends, positions)]
        # every run's first position is a sample, so walking back never leaves a run
        sampled = ((positions - run_start) % SAMPLE_EVERY == 0)[order]
        self.sampled = BitVector(sampled)
        self.samples = order[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the phrases, given right-aligned in the columns of a matrix."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.n, dtype=np.int64)
        width = phrases.shape[1]
        for step in range(width):
            live = np.flatnonzero((lengths > step) & (high > low))
            if not len(live):
                break
            symbols = phrases[live, width - 1 - step]
            low[live] = self.before[symbols] + self.tree.rank(symbols, low[live])
            high[live] = self.before[symbols] + self.tree.rank(symbols, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back to the nearest sample and count the steps."""
        found = np.empty(len(rows), dtype=np.int64)
        at, steps, open_rows = rows.copy(), 0, np.arange(len(rows))
        while len(open_rows):
            hit = self.sampled.get(at)
            found[open_rows[hit]] = self.samples[self.sampled.rank(at[hit])] + steps
            open_rows, at = open_rows[~hit], at[~hit]
            if len(open_rows):
                symbols, ranks = self.tree.access(at)
                at = self.before[symbols] + ranks
            steps += 1
        return found
