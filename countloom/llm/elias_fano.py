"""Monotone numbers in few bits, searched without unpacking.

Of each number the low bits are kept as they are, and the high ones in unary: one bit per number and one
per step of the high part, some ``2 + log2(universe / n)`` bits each.  All parts are plain arrays of one
buffer, so a structure is written and mapped into memory as it is.  Queries take and return arrays.
"""

from __future__ import annotations

import numpy as np

WORD = np.uint64(64)
ONE = np.uint64(1)


def _bits_to_words(bits: np.ndarray) -> np.ndarray:
    """Two words more than needed, so that reads may run over the end."""
    packed = np.packbits(bits, bitorder="little")
    words = np.zeros(len(bits) // 64 + 3, "<u8")
    words.view(np.uint8)[: len(packed)] = packed
    return words


def _nth_set(words: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Place of the ``n``-th set bit, from 0, of each word, by halving."""
    place = np.zeros(len(words), np.uint64)
    n = n.astype(np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        low = (words >> place) & np.uint64((1 << width) - 1)
        count = np.bitwise_count(low).astype(np.int64)
        beyond = n >= count
        n = np.where(beyond, n - count, n)
        place = np.where(beyond, place + np.uint64(width), place)
    return place.astype(np.int64)


class EliasFano:
    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        # Directories: set and unset bits before each word of the unary part.
        ones = np.bitwise_count(high).astype(np.int64)
        self.ones = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = np.arange(len(high) + 1) * 64 - self.ones

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        """``values`` do not fall, and lie below ``universe``."""
        n = len(values)
        low_bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        low = np.zeros(n * low_bits, np.uint8)
        for j in range(low_bits):
            low[j::low_bits] = (values >> np.uint64(j)).astype(np.uint8) & 1
        upper = (values >> np.uint64(low_bits)).astype(np.int64)
        high = np.zeros(n + (universe >> low_bits) + 2, np.uint8)
        high[upper + np.arange(n)] = 1
        return cls(n, low_bits, _bits_to_words(low), _bits_to_words(high))

    def parts(self) -> list[np.ndarray]:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high)], "<u8")
        return [head, self.low, self.high]

    @classmethod
    def read(cls, words: np.ndarray, at: int) -> tuple[EliasFano, int]:
        """From 64-bit words, mapped or not; and where the next structure begins."""
        n, low_bits, a, b = (int(x) for x in words[at : at + 4])
        at += 4
        return cls(n, low_bits, words[at : at + a], words[at + a : at + a + b]), at + a + b

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), np.uint64)
        bit = index.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        spill = np.where(shift > 0, self.low[word + 1] << ((WORD - shift) & np.uint64(63)), np.uint64(0))
        return ((self.low[word] >> shift) | spill) & np.uint64((1 << self.low_bits) - 1)

    def get(self, index: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, index, side="right") - 1
        place = word * 64 + _nth_set(self.high[word], index - self.ones[word])
        return ((place - index).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(index)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.zeros, k, side="right") - 1
        return word * 64 + _nth_set(~self.high[word], k - self.zeros[word])

    def find(self, values: np.ndarray, first: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """The index of each value, at or after ``first`` and before ``end``, or -1."""
        values = values.astype(np.uint64)
        upper = (values >> np.uint64(self.low_bits)).astype(np.int64)
        begin = np.where(upper > 0, self._zero(np.maximum(upper - 1, 0)) - np.maximum(upper - 1, 0), 0)
        stop = self._zero(upper) - upper
        if first is not None:
            begin, stop = np.maximum(begin, first), np.minimum(stop, end)
        low = values & np.uint64((1 << self.low_bits) - 1)
        left, right = begin.copy(), stop.copy()
        while (open_ := np.flatnonzero(left < right)).size:
            middle = (left[open_] + right[open_]) // 2
            less = self._low(middle) < low[open_]
            left[open_] = np.where(less, middle + 1, left[open_])
            right[open_] = np.where(less, right[open_], middle)
        hit = left < stop
        hit[hit] = self._low(left[hit]) == low[hit]
        return np.where(hit, left, -1)
