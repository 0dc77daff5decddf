"""Elias-Fano sequences in numpy, searched by array operations.

A rising sequence of n numbers below u keeps the lowest l = log2(u / n) bits of
each number as they are. The higher parts go into a bit vector: for each value
of the higher part, a one per number that has it and then a zero. The place of
the h-th zero gives where the numbers with higher part h end, so a search is
one select, the length of the run of ones that follows, and a binary search
among the numbers that share their higher part.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
#: A one in each byte of a word, and its highest bit.
EACH, TOP = U64(0x0101010101010101), U64(0x8080808080808080)
#: The place of the k-th one of a byte, at k x 256 + byte.
PLACE = np.array([([i for i in range(8) if byte >> i & 1] + [0] * 8)[k] for k in range(8) for byte in range(256)], dtype=np.int64)


def select1(x: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The place of the k-th one of each word, from 0: its byte by the bytes' running counts, all at once, the bit by a table."""
    s = x - (x >> U64(1) & U64(0x5555555555555555))
    s = (s & U64(0x3333333333333333)) + (s >> U64(2) & U64(0x3333333333333333))
    s = (s + (s >> U64(4)) & U64(0x0F0F0F0F0F0F0F0F)) * EACH
    k = k.astype(U64)
    at = np.bitwise_count((k * EACH | TOP) - s & TOP).astype(U64) << U64(3)
    left = k - (s << U64(8) >> at & U64(255))
    return at.astype(np.int64) + PLACE[(left << U64(8) | x >> at & U64(255)).astype(np.int64)]


def rising(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """(the keys in order, what sorts them; None if they are sorted)."""
    if (keys[1:] >= keys[:-1]).all():
        return keys, None
    order = np.argsort(keys)
    return keys[order], order


def restored_order(values: np.ndarray, order: np.ndarray | None) -> np.ndarray:
    """What was found for sorted keys, in the order of the keys as given."""
    if order is None:
        return values
    out = np.empty_like(values)
    out[order] = values
    return out


class EliasFano:
    FIELDS = ("low", "more", "bits", "ranks")

    def __init__(self, base: int, n: int, shift: int, low: np.ndarray, more: np.ndarray, bits: np.ndarray, ranks: np.ndarray):
        self.base, self.n, self.shift, self.low, self.more, self.bits, self.ranks = base, n, shift, low, more, bits, ranks
        self.top = 0 if not n else None

    @classmethod
    def build(cls, values: np.ndarray) -> "EliasFano":
        """From rising int64 numbers, all different."""
        n = len(values)
        if not n:
            return cls(0, 0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(1, U64), np.zeros(1, np.uint32))
        base = int(values[0])
        rest = (values - base).astype(U64)
        universe = int(rest[-1]) + 1
        shift = max(0, (universe // n).bit_length() - 1)
        kind = np.uint8 if shift <= 8 else np.uint16 if shift <= 24 else np.uint32 if shift <= 32 else U64
        low = rest & U64((1 << shift) - 1)
        more = (low >> U64(16)).astype(np.uint8) if 16 < shift <= 24 else np.zeros(0, np.uint8)  # 17 to 24 bits take three bytes
        high = (rest >> U64(shift)).astype(np.int64)
        size = n + int(high[-1]) + 1
        flags = np.zeros(-(-size // 64) * 64 + 64, dtype=bool)
        flags[high + np.arange(n)] = True
        bits = np.packbits(flags, bitorder="little").view(U64)
        # zeros before each word of 64 bits
        ranks = np.concatenate([[0], np.cumsum(64 - np.bitwise_count(bits).astype(np.int64))[:-1]])
        return cls(base, n, shift, low.astype(kind), more, bits, ranks.astype(np.uint32 if size < 2 ** 32 else U64))

    def low_at(self, i: np.ndarray) -> np.ndarray:
        low = self.low[i].astype(np.int64)
        return low | self.more[i].astype(np.int64) << 16 if len(self.more) else low

    def select0(self, k: np.ndarray) -> np.ndarray:
        """The place of the k-th zero, from 0: the word by binary search on the ranks."""
        word = np.searchsorted(self.ranks, k.astype(self.ranks.dtype), side="right") - 1
        return word * 64 + select1(~self.bits[word], k - self.ranks[word].astype(np.int64))

    def run(self, start: np.ndarray, h: np.ndarray) -> np.ndarray:
        """How many ones there are from the places ``start`` up to the h-th zero, which ends them: read from one word's bits where it is that near."""
        word, off = start >> 6, (start & 63).astype(U64)
        zeros = ~(self.bits[word] >> off) & ~U64(0) >> off  # of the rest of the word
        n = np.bitwise_count((zeros & (~zeros + U64(1))) - U64(1)).astype(np.int64)
        far = np.flatnonzero(zeros == 0)
        if len(far):
            n[far] = self.select0(h[far]) - start[far]
        return n

    def lower_bound(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(how many numbers are below each key, whether the key is there)."""
        out, found = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
        if not self.n:
            return out, found
        if self.top is None:
            self.top = len(self.bits) * 64 - 64
            self.highest = self._highest()
        rest = keys - self.base
        high = rest >> self.shift
        within = (rest >= 0) & (high <= self.highest)
        if not within.all():
            out[high > self.highest] = self.n
            inside = np.flatnonzero(within)
            out[inside], found[inside] = self._inside(high[inside], rest[inside] & ((1 << self.shift) - 1))
            return out, found
        return self._inside(high, rest & ((1 << self.shift) - 1))

    def _inside(self, h: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``lower_bound`` of keys whose higher parts occur or lie between such."""
        start = np.where(h > 0, self.select0(np.maximum(h - 1, 0)) + 1, 0)
        out = start - h
        many = self.run(start, h)
        found = np.zeros(len(h), dtype=bool)
        todo = np.flatnonzero(many)
        lo, hi, low = out[todo], (out + many)[todo], low[todo]
        while len(todo):
            mid = (lo + hi) >> 1
            there = self.low_at(mid)
            lo, hi = np.where(there < low, mid + 1, lo), np.where(there < low, hi, mid)
            # a number that was looked at and is equal is the only one: its place is where the search ends
            found[todo[there == low]] = True
            unsettled = lo < hi
            done = todo[~unsettled]
            out[done] = lo[~unsettled]
            todo, lo, hi, low = todo[unsettled], lo[unsettled], hi[unsettled], low[unsettled]
        return out, found

    def values(self) -> np.ndarray:
        """All numbers."""
        ones = np.flatnonzero(np.unpackbits(self.bits.view(np.uint8), bitorder="little"))[:self.n]
        return (ones - np.arange(self.n) << self.shift) + self.low_at(np.arange(self.n)) + self.base

    def _highest(self) -> int:
        """The higher part of the last number: the zeros before the last one bit."""
        w = int(np.flatnonzero(self.bits)[-1])
        last = w * 64 + int(self.bits[w]).bit_length() - 1
        return last - (self.n - 1)


class Shards:
    """A rising sequence cut into Elias-Fano shards, numbered through."""

    def __init__(self, shards: list[EliasFano]):
        self.shards = [s for s in shards if s.n]
        self.bases = np.array([s.base for s in self.shards], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum([s.n for s in self.shards])]).astype(np.int64)

    def __len__(self) -> int:
        return int(self.first[-1])

    def lower_bound(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out, found = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
        if len(self.shards) == 1:
            return self.shards[0].lower_bound(keys)
        keys, order = rising(keys)
        cut = np.append(np.searchsorted(keys, self.bases), len(keys))
        for i, s in enumerate(self.shards):
            if cut[i] < cut[i + 1]:
                own = slice(cut[i], cut[i + 1])
                at, there = s.lower_bound(keys[own])
                out[own], found[own] = at + self.first[i], there
        return restored_order(out, order), restored_order(found, order)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key in the sequence, -1 where it is not there."""
        at, found = self.lower_bound(keys)
        return np.where(found, at, -1)
