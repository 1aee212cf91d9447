"""Elias-Fano coding of non-decreasing sequences of non-negative integers.

The low ``l`` bits of every value are packed side by side; the high parts are
written in unary into a bit vector with one 1 per value. A sample of the
positions of every ``SAMPLE``-th 1 makes ``select`` a short scan. Space is
about ``n * (2 + log2(universe / n))`` bits instead of 64 per value.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEADER = struct.Struct("<QQB7xQ")  # values, largest value, low bits, bytes of the high part


class EliasFano:
    """A decoded header with random access to the values."""

    def __init__(self, n: int, largest: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.largest, self.low_bits = n, largest, low_bits
        self._low, self._high, self._samples = low, high, samples

    # -- building -----------------------------------------------------------
    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        if n and np.any(values[1:] < values[:-1]):
            raise ValueError("values must not decrease")
        largest = int(values[-1]) if n else 0
        low_bits = max(0, (largest // n).bit_length() - 1) if n else 0
        low_part = values & np.uint64((1 << low_bits) - 1)
        bits = (low_part[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        mask = np.zeros((int(ones[-1]) + 1) if n else 0, dtype=np.uint8)
        mask[ones] = 1
        high = np.packbits(mask, bitorder="little").tobytes()
        return cls(n, largest, low_bits, low, high, ones[::SAMPLE].astype("<u8"))

    def to_bytes(self) -> bytes:
        return b"".join(
            [_HEADER.pack(self.n, self.largest, self.low_bits, len(self._high)), self._low, self._high, self._samples.tobytes()]
        )

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, largest, low_bits, high_bytes = _HEADER.unpack_from(data)
        a = _HEADER.size
        b = a + (n * low_bits + 7) // 8
        c = b + high_bytes
        return cls(n, largest, low_bits, data[a:b], data[b:c], np.frombuffer(data, "<u8", -(-n // SAMPLE), c))

    # -- reading ------------------------------------------------------------
    def select(self, i: int) -> int:
        """Value ``i`` (from 0), from the nearest sampled 1 onwards."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self._samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        word = self._high[byte] >> (at & 7) << (at & 7)
        while (found := word.bit_count()) <= left:
            left -= found
            byte += 1
            word = self._high[byte]
        for _ in range(left):
            word &= word - 1
        one = byte * 8 + (word & -word).bit_length() - 1
        start = i * self.low_bits
        chunk = int.from_bytes(self._low[start >> 3 : (start + self.low_bits + 7) >> 3], "little")
        return (one - i) << self.low_bits | (chunk >> (start & 7)) & ((1 << self.low_bits) - 1)

    def part(self, first: int, last: int) -> np.ndarray:
        """Values ``first`` to ``last`` - 1, decoded from the sampled 1 before
        ``first`` to the one after ``last`` only."""
        last = min(last, self.n)
        if first >= last:
            return np.empty(0, np.uint64)
        group, after = first // SAMPLE, -(-last // SAMPLE)
        start = int(self._samples[group]) >> 3
        stop = (int(self._samples[after]) >> 3) + 1 if after < len(self._samples) else len(self._high)
        bits = np.unpackbits(np.frombuffer(self._high, np.uint8, stop - start, start), bitorder="little")
        bits[: int(self._samples[group]) & 7] = 0  # 1s of values before the group
        skip = first - group * SAMPLE
        ones = np.flatnonzero(bits)[skip : skip + last - first] + 8 * start
        high = (ones - np.arange(first, last)).astype(np.uint64) << np.uint64(self.low_bits)
        if not self.low_bits:
            return high
        at, end = first * self.low_bits, last * self.low_bits
        low = np.unpackbits(np.frombuffer(self._low, np.uint8, ((end + 7) >> 3) - (at >> 3), at >> 3), bitorder="little")
        low = low[at & 7 : (at & 7) + end - at].reshape(-1, self.low_bits)
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return high | (low.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)

    def values(self) -> np.ndarray:
        """All values at once."""
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self._high, np.uint8), bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if not self.low_bits or not self.n:
            return high
        bits = np.unpackbits(np.frombuffer(self._low, np.uint8), bitorder="little", count=self.n * self.low_bits)
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return high | (bits.reshape(self.n, self.low_bits).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
