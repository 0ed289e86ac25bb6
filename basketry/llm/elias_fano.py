"""Elias-Fano form of a non-decreasing sequence of integers, with selection by position.

A value is cut in two. The low bits, as many as make the high parts about as dense as the sequence, are packed side by
side. The high parts are written in unary: position ``high(i) + i`` of a bit vector is one. ``select`` finds the i-th
one from a sample of every ``SAMPLE``-th one, so that a value needs no table of 64-bit offsets.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<qqBqq")  # count, base, low bits, bytes of low part, bytes of high part
_POPCOUNT = np.array([bin(b).count("1") for b in range(256)], dtype=np.int64)


class EliasFano:
    def __init__(self, count: int, base: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.count, self.base, self.low_bits, self.low, self.high = count, base, low_bits, low, high
        ones = np.concatenate(([0], np.cumsum(_POPCOUNT[high]))) if len(high) else np.zeros(1, np.int64)
        # the byte that holds every SAMPLE-th one, and the ones before that byte
        self._byte = np.searchsorted(ones, np.arange(0, max(count, 1), SAMPLE), side="right") - 1
        self._before = ones[self._byte]

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.int64)
        count = len(values)
        if not count:
            return cls(0, 0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8))
        if (np.diff(values) < 0).any():
            raise ValueError("the values must not decrease")
        base = int(values[0])
        offsets = values.astype(np.uint64) - np.uint64(base % 2**64)
        low_bits = max(0, (int(offsets[-1]) // count).bit_length() - 1)
        low = np.zeros(0, np.uint8)
        if low_bits:
            bits = (offsets[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
            low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        places = (offsets >> np.uint64(low_bits)).astype(np.int64) + np.arange(count)
        marks = np.zeros(int(places[-1]) + 1, np.uint8)
        marks[places] = 1
        return cls(count, base, low_bits, low, np.packbits(marks, bitorder="little"))

    def _low(self, first: int, last: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(last - first, np.int64)
        start, end = first * self.low_bits, last * self.low_bits
        bits = np.unpackbits(self.low[start // 8 : (end + 7) // 8], bitorder="little")[start % 8 :][: end - start]
        return bits.reshape(-1, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))

    def select(self, i: int) -> int:
        """The i-th value."""
        return int(self.slice(i, i + 1)[0])

    def slice(self, first: int, last: int) -> np.ndarray:
        """The values from ``first`` up to ``last``, the latter excluded."""
        if not 0 <= first <= last <= self.count:
            raise IndexError(f"{first}:{last} of {self.count}")
        if first == last:
            return np.zeros(0, np.int64)
        start = int(self._byte[first // SAMPLE])
        until = (last - 1) // SAMPLE + 1
        end = int(self._byte[until]) + 1 if until < len(self._byte) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[start:end], bitorder="little")) + 8 * start
        skip = first - int(self._before[first // SAMPLE])
        high = ones[skip : skip + last - first] - np.arange(first, last)
        return ((high << self.low_bits) | self._low(first, last)) + self.base

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.count, self.base, self.low_bits, len(self.low), len(self.high))
        return head + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence that starts at ``at``, and where it ends."""
        count, base, low_bits, n_low, n_high = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        return cls(count, base, low_bits, low, high), at + n_low + n_high
