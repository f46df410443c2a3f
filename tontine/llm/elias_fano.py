"""Elias-Fano coding of a non-decreasing sequence.

n values below u take about 2 + log2(u / n) bits each: the low bits are packed as they are, the
high bits set one bit each in a bit vector at (high part + index). ``select`` finds the i-th one
from a sampled position and so returns any value without decoding the rest.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<QQIIQQ")  # values, last value, low bits, sample step, bytes of low part, bytes of high part
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def encode(values: np.ndarray) -> bytes:
    v = np.asarray(values, dtype=np.uint64)
    n, last = len(v), int(v[-1]) if len(v) else 0
    if n and (v[1:] < v[:-1]).any():
        raise ValueError("values must not decrease")
    low = max(0, ((last + 1) // max(1, n)).bit_length() - 1)
    bits = ((v[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    lows = np.packbits(bits.ravel(), bitorder="little").tobytes()
    at = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
    high = np.zeros((int(at[-1]) // 8 + 1) * 8 if n else 0, dtype=np.uint8)
    high[at] = 1
    highs = np.packbits(high, bitorder="little").tobytes()
    return _HEAD.pack(n, last, low, SAMPLE, len(lows), len(highs)) + lows + highs + at[::SAMPLE].astype("<u4" if len(high) < 1 << 32 else "<u8").tobytes()


class EliasFano:
    """Read access to an encoded sequence."""

    def __init__(self, data: bytes):
        self.n, self.last, self.low, self.step, a, b = _HEAD.unpack_from(data)
        at = _HEAD.size
        self._lows = np.frombuffer(data, np.uint8, a, at)
        self._highs = np.frombuffer(data, np.uint8, b, at + a)
        wide = "<u4" if b * 8 < 1 << 32 else "<u8"
        self._samples = np.frombuffer(data, wide, -(-self.n // self.step), at + a + b)

    def __len__(self) -> int:
        return self.n

    def _low(self, i: int) -> int:
        if not self.low:
            return 0
        first = i * self.low
        part = int.from_bytes(self._lows[first // 8:(first + self.low + 7) // 8].tobytes(), "little")
        return (part >> (first % 8)) & ((1 << self.low) - 1)

    def select(self, i: int) -> int:
        """The i-th value."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self._samples[i // self.step]), i % self.step
        byte = at // 8
        seen = int(_ONES[int(self._highs[byte]) & ((1 << (at % 8)) - 1)])
        left += seen
        while True:
            ones = _ONES[self._highs[byte:byte + 64]]
            run = np.cumsum(ones)
            if len(run) and int(run[-1]) > left:
                k = int(np.searchsorted(run, left, side="right"))
                left -= int(run[k - 1]) if k else 0
                bit = int(np.flatnonzero(np.unpackbits(self._highs[byte + k:byte + k + 1], bitorder="little"))[left])
                return (((byte + k) * 8 + bit - i) << self.low) | self._low(i)
            left -= int(run[-1])
            byte += 64

    def all(self) -> np.ndarray:
        """Every value, decoded at once."""
        if not self.n:
            return np.zeros(0, dtype=np.uint64)
        at = np.flatnonzero(np.unpackbits(self._highs, bitorder="little"))[:self.n]
        high = (at - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low)
        if not self.low:
            return high
        bits = np.unpackbits(self._lows, bitorder="little")[:self.n * self.low].reshape(self.n, self.low)
        return high | (bits.astype(np.uint64) << np.arange(self.low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
