"""Elias-Fano sequences over plain buffers, with vectorised access and successor search.

A non-decreasing sequence of n numbers below u keeps the low bits of each
number packed, and the high bits as a bitmap in which every number is a one
and every step of the high part a zero: about 2 + log2(u / n) bits a number.
A running count of ones per 64-bit word finds the i-th one or zero. All parts
are views of one buffer, so a sequence can be memory-mapped.
"""

from __future__ import annotations

import struct

import numpy as np

_BITS = np.array([bin(b).count("1") for b in range(256)], dtype=np.int64)
_NTH = np.zeros((256, 8), dtype=np.int64)
for _b in range(256):
    _at = [i for i in range(8) if _b >> i & 1]
    _NTH[_b, :len(_at)] = _at
_HEAD = "<4Q"
_SLICE = 1 << 14


def _select(words: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Place of the nth one (from 0) of each word."""
    place = np.zeros(len(words), dtype=np.int64)
    left, open_ = nth.astype(np.int64), np.ones(len(words), dtype=bool)
    for i in range(8):
        byte = ((words >> np.uint64(8 * i)) & np.uint64(255)).astype(np.int64)
        count = _BITS[byte]
        here = open_ & (left < count)
        place[here] = 8 * i + _NTH[byte[here], left[here]]
        open_ &= ~here
        left = left - count
    return place


class EliasFano:
    """Read-only view of an encoded sequence at ``offset`` of ``buffer``; ``end`` is where its bytes end."""

    def __init__(self, buffer, offset: int = 0):
        self.n, bits, n_low, n_high = struct.unpack_from(_HEAD, buffer, offset)
        at = offset + struct.calcsize(_HEAD)
        self.bits = np.uint64(bits)
        self.low = np.frombuffer(buffer, np.uint64, n_low, at)
        self.high = np.frombuffer(buffer, np.uint64, n_high, at + 8 * n_low)
        self.ones = np.frombuffer(buffer, np.uint32, n_high, at + 8 * (n_low + n_high))
        self.end = at + 8 * (n_low + n_high) + 4 * (n_high + n_high % 2)

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> bytes:
        """Bytes (a multiple of 8) of non-decreasing ``values`` below ``universe`` (at most 2 ** 64)."""
        values = values.astype(np.uint64)
        n = len(values)
        bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        packed = np.zeros(n * bits // 64 + 2, dtype=np.uint64)
        if bits:
            shifts, raw = np.arange(bits, dtype=np.uint64), packed.view(np.uint8)
            for at in range(0, n, _SLICE):  # a slice's bits fill whole bytes
                flags = ((values[at:at + _SLICE, None] >> shifts) & np.uint64(1)).astype(np.uint8)
                part = np.packbits(flags.reshape(-1), bitorder="little")
                raw[at * bits // 8:at * bits // 8 + len(part)] = part
        tops = (values >> np.uint64(bits)).astype(np.int64) if bits < 64 else np.zeros(n, np.int64)
        size = n + int((universe - 1) >> bits) + 2
        marks = np.zeros((size + 63) // 64 * 64, dtype=np.uint8)
        marks[tops + np.arange(n)] = 1
        words = np.packbits(marks, bitorder="little").view(np.uint64)
        ones = np.cumsum(marks.reshape(-1, 64).sum(1, dtype=np.int64))
        before = np.concatenate([[0], ones])[:-1].astype(np.uint32)
        pad = b"\0" * 4 * (len(words) % 2)
        return struct.pack(_HEAD, n, bits, len(packed), len(words)) + packed.tobytes() + words.tobytes() + before.tobytes() + pad

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), dtype=np.uint64)
        at = i.astype(np.uint64) * self.bits
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        more = (self.low[word + 1] << (np.uint64(63) - shift)) << np.uint64(1)
        value = (self.low[word] >> shift) | more
        return value if self.bits == 64 else value & ((np.uint64(1) << self.bits) - np.uint64(1))

    def _one(self, k: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, k, "right") - 1
        return 64 * word + _select(self.high[word], k - self.ones[word])

    def _zero(self, k: np.ndarray) -> np.ndarray:
        zeros = 64 * np.arange(len(self.ones), dtype=np.int64) - self.ones
        word = np.searchsorted(zeros, k, "right") - 1
        return 64 * word + _select(~self.high[word], k - zeros[word])

    def get(self, i: np.ndarray) -> np.ndarray:
        """The numbers at the places ``i``."""
        i = np.asarray(i, dtype=np.int64)
        high = (self._one(i) - i).astype(np.uint64)
        return self._low(i) if self.bits == 64 else (high << self.bits) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first number >= x, whether it equals x); the place is n if there is none."""
        x = np.asarray(x, dtype=np.uint64)
        if not self.n:
            return np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=bool)
        top = (x >> self.bits).astype(np.int64) if self.bits < 64 else np.zeros(len(x), np.int64)
        rest = x if self.bits == 64 else x & ((np.uint64(1) << self.bits) - np.uint64(1))
        place = np.zeros(len(x), dtype=np.int64)
        later = top > 0
        place[later] = self._zero(top[later] - 1) - (top[later] - 1)
        stop = self._zero(top) - top
        equal = np.zeros(len(x), dtype=bool)
        open_ = np.flatnonzero(place < stop)
        while len(open_):  # the numbers that share the high part
            value = self._low(place[open_])
            equal[open_[value == rest[open_]]] = True
            open_ = open_[value < rest[open_]]
            place[open_] += 1
            open_ = open_[place[open_] < stop[open_]]
        return place, equal
