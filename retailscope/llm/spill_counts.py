"""Counting pairs over more records than fit in memory: sorted, compressed runs and their merge.

A record says that a place (a row of the task that wrote the run) holds a pair so many times. The pair is one
number, led by the side it is ranked by (``PairCode``), so that sorting goes side by side; sides are dealt to
radix parts. A task sorts what it holds, cuts it at the radix boundaries and compresses each part: a run. Runs
of one part merge with a heap into counts; as they come side by side, a side's largest count is known as soon
as the side ends.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import zstandard

BLOCK = 1 << 16
LEVEL = 1
HEAD = "<III"


@dataclass(frozen=True)
class PairCode:
    """Pairs of a side below ``sides`` and a partner below ``partners`` as numbers in radix-major, side-major order."""

    sides: int
    partners: int
    parts: int

    @property
    def partner_bits(self) -> int:
        return max(1, (self.partners - 1).bit_length())

    @property
    def rows(self) -> int:
        """Sides of one part."""
        return -(-self.sides // self.parts)

    @property
    def place_bits(self) -> int:
        """Bits a record has left for its place."""
        return 63 - self.partner_bits - (self.rows * self.parts - 1).bit_length()

    def of(self, side: int, partner: int) -> int:
        return (side % self.parts * self.rows + side // self.parts) << self.partner_bits | partner

    def side_rank(self, codes):
        return codes >> self.partner_bits

    def first_of(self, part: int) -> int:
        """The least number of a part; that of ``parts`` is above all."""
        return part * self.rows << self.partner_bits


def packed(values: np.ndarray) -> bytes:
    """Integers of eight bytes, byte planes apart, compressed."""
    planes = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=LEVEL).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").reshape(-1)


def write_blocks(keys: np.ndarray, values: np.ndarray) -> bytes:
    """Ascending keys, as differences, and their values in blocks that can be read one at a time."""
    out = []
    for start in range(0, len(keys), BLOCK):
        own = keys[start : start + BLOCK]
        parts = packed(np.diff(own, prepend=0)), packed(values[start : start + BLOCK])
        out += [struct.pack(HEAD, len(own), *map(len, parts)), *parts]
    return b"".join(out)


def read_blocks(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    at = 0
    while at < len(data):
        _, first, second = struct.unpack_from(HEAD, data, at)
        at += struct.calcsize(HEAD)
        yield np.cumsum(unpacked(data[at : at + first])), unpacked(data[at + first : at + first + second])
        at += first + second


def cut_runs(records: np.ndarray, code: PairCode) -> Iterator[tuple[int, bytes]]:
    """(part, run) of records ``pair << place_bits | place``, equal ones counted. The array is sorted in place."""
    records.sort()
    first = np.flatnonzero(np.diff(records, prepend=-1))
    times = np.diff(first, append=len(records))
    records = records[first]
    bounds = np.searchsorted(records, [code.first_of(p) << code.place_bits for p in range(1, code.parts)])
    for part, (low, high) in enumerate(zip([0, *bounds], [*bounds, len(records)])):
        if high > low:
            yield part, write_blocks(records[low:high], times[low:high])


def pairs_of(run: bytes, place_bits: int) -> Iterator[tuple[int, int]]:
    """(pair, count) of one run, ascending; a pair that crosses blocks comes in pieces."""
    for keys, times in read_blocks(run):
        pairs = keys >> place_bits
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        yield from zip(pairs[first].tolist(), np.add.reduceat(times, first).tolist())


def merge_counts(streams: Iterable[Iterator[tuple[int, int]]]) -> Iterator[tuple[int, int]]:
    """(pair, count) over all ascending streams, each pair once: a k-way merge with a heap."""
    for pair, same in groupby(heapq.merge(*streams, key=itemgetter(0)), key=itemgetter(0)):
        yield pair, sum(n for _, n in same)


def with_maxima(counts: Iterable[tuple[int, int]], code: PairCode) -> Iterator[tuple[int, int, bool]]:
    """(pair, count, whether no other pair of its side has more), streaming: one side is held at a time."""
    for _, side in groupby(counts, key=lambda pair: code.side_rank(pair[0])):
        held = list(side)
        most = max(n for _, n in held)
        for pair, n in held:
            yield pair, n, n == most


def contributions(run: bytes, place_bits: int, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, ...]:
    """(places, occurrences of best pairs, sum of counts over occurrences) of one run, given its part's counted pairs."""
    places, n_best, total = [], [], []
    for keys, times in read_blocks(run):
        at = np.searchsorted(pairs, keys >> place_bits)
        places.append(keys & ((1 << place_bits) - 1))
        n_best.append(times * best[at])
        total.append(times * counts[at])
    own, index = np.unique(np.concatenate(places), return_inverse=True)
    sums = np.zeros((2, len(own)), dtype=np.int64)
    np.add.at(sums[0], index, np.concatenate(n_best))
    np.add.at(sums[1], index, np.concatenate(total))
    return own, sums[0], sums[1]
