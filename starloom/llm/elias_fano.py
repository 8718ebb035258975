"""Elias-Fano sequences over memory-mapped words, read by whole arrays of queries at a time."""

from __future__ import annotations

import numpy as np

# _SELECT[byte, k]: the place of the k-th one (from 0) of a byte.
_SELECT = np.zeros((256, 8), np.uint8)
for _b in range(256):
    for _k, _p in enumerate(p for p in range(8) if _b >> p & 1):
        _SELECT[_b, _k] = _p


class EliasFano:
    """A non-decreasing sequence of n values below ``universe``.

    The low ``bits`` bits of each value are packed; the high part of value i is a one at place
    (high + i) of a bit vector, so about 2 + log2(universe / n) bits a value. ``ones[w]`` counts the
    ones before word w of the vector: the directory for select.
    """

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.bits, self.low, self.high, self.ones = n, bits, low, high, ones
        self._zeros: np.ndarray | None = None

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        bits = max(0, int(universe // max(1, n)).bit_length() - 1)
        mask = np.uint64((1 << bits) - 1)
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits and n:
            at = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            own = values & mask
            # Values whose first bit lies in one word never overlap in it.
            np.bitwise_or.at(low, word, own << off)
            over = off + np.uint64(bits) > np.uint64(64)
            np.bitwise_or.at(low, word[over] + 1, own[over] >> (np.uint64(64) - off[over]))
        place = ((values >> np.uint64(bits)) + np.arange(n, dtype=np.uint64)).astype(np.int64)
        size = (int(universe) >> bits) + n + 2
        flags = np.zeros((size + 63) // 64 * 64, np.uint8)
        flags[place] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.uint64)]).astype(np.uint64)
        return cls(n, bits, low, high, ones)

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.bits, len(self.low), len(self.high)], np.uint64), self.low, self.high, self.ones]

    @classmethod
    def read(cls, words: np.ndarray, at: int) -> tuple[EliasFano, int]:
        """From 64-bit words (a memory map) at a place; returns the place behind it too."""
        n, bits, lows, highs = (int(x) for x in words[at : at + 4])
        a = at + 4
        b, c = a + lows, a + lows + highs
        end = c + highs + 1
        return cls(n, bits, words[a:b], words[b:c], words[c:end]), end

    @staticmethod
    def _select_in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The place of the k-th one (from 0) of each word: halves are counted down to a byte."""
        left, place = k.astype(np.int64), np.zeros(len(word), np.int64)
        for width in (32, 16, 8):
            half = word & np.uint64((1 << width) - 1)
            ones = np.bitwise_count(half).astype(np.int64)
            upper = left >= ones
            left = np.where(upper, left - ones, left)
            word = np.where(upper, word >> np.uint64(width), half)
            place += width * upper
        return place + _SELECT[(word & np.uint64(255)).astype(np.intp), left]

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.bits)
        word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        # A shift by 64 is split in two, since it is undefined as one.
        value = (self.low[word] >> off) | ((self.low[word + 1] << (np.uint64(63) - off)) << np.uint64(1))
        return value & np.uint64((1 << self.bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at places i."""
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self.ones, i.astype(np.uint64), side="right") - 1
        place = word * 64 + self._select_in_word(self.high[word], i - self.ones[word].astype(np.int64))
        return ((place - i).astype(np.uint64) << np.uint64(self.bits)) | self._lows(i)

    def _select_zero(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, place in it) of the k-th zero (from 0)."""
        if self._zeros is None:
            self._zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones.astype(np.int64)
        word = np.searchsorted(self._zeros, k, side="right") - 1
        return word, self._select_in_word(~self.high[word], k - self._zeros[word])

    def _between_zeros(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ones stand before the zero in front of the k-th (from 0), and before the k-th. Their
        difference is the run of ones right below the k-th zero; it is selected where it leaves the word."""
        word, at = self._select_zero(k)
        end = word * 64 + at - k
        # Ones at the top of what lies below the zero: 64 less the bits at and below the first zero there.
        rest = ~(self.high[word] << (np.uint64(64) - at.astype(np.uint64) & np.uint64(63)))
        for width in (1, 2, 4, 8, 16, 32):
            rest |= rest >> np.uint64(width)
        run = 64 - np.bitwise_count(rest).astype(np.int64)
        start = end - run
        over = np.flatnonzero((run >= at) & (k > 0))
        if len(over):
            w, p = self._select_zero(k[over] - 1)
            start[over] = w * 64 + p - (k[over] - 1)
        start[k == 0] = 0
        return start, end

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of each value, or -1: a successor search among the values with the same high
        part, whose ends are found by select over the zeros. Most are one or two: they are looked at in
        turn, and only where there are more a binary search goes on."""
        x = np.asarray(x, np.uint64)
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        high, low = (x >> np.uint64(self.bits)).astype(np.int64), x & np.uint64((1 << self.bits) - 1)
        a, end = self._between_zeros(high)
        live = np.flatnonzero(a < end)
        a, end, low = a[live], end[live], low[live]
        for _ in range(3):
            value = self._lows(a)
            hit = value == low
            out[live[hit]] = a[hit]
            on = (value < low) & (a + 1 < end)
            live, a, end, low = live[on], a[on] + 1, end[on], low[on]
        b = end.copy()
        left = np.arange(len(live))
        while len(left):
            middle = (a[left] + b[left]) >> 1
            less = self._lows(middle) < low[left]
            a[left[less]] = middle[less] + 1
            b[left[~less]] = middle[~less]
            left = left[a[left] < b[left]]
        some = np.flatnonzero(a < end)
        hit = some[self._lows(a[some]) == low[some]]
        out[live[hit]] = a[hit]
        return out
