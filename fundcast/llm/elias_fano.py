"""Elias-Fano coding of ascending integers.

``n`` values below ``u`` take about ``n * (2 + log2(u / n))`` bits: the low bits
of each value are packed, the high parts are written in unary. Every
``SAMPLE``-th one bit of the unary part is indexed, so ``select`` reads one
short stretch of it.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<QqBQ")  # count, smallest value, low bits, bytes of the unary part


def encode(values: np.ndarray) -> bytes:
    """Bytes of an ascending int64 sequence (empty allowed)."""
    n = len(values)
    base = int(values[0]) if n else 0
    v = values.astype(np.int64).view(np.uint64) - np.uint64(base & (1 << 64) - 1)
    span = int(v[-1]) + 1 if n else 1
    low = max(0, (span // max(n, 1)).bit_length() - 1)
    bits = (v[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1) if low else np.zeros((n, 0))
    lows = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
    ones = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
    unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    unary[ones] = 1
    high = np.packbits(unary, bitorder="little")
    samples = ones[::SAMPLE].astype("<u8")
    return _HEAD.pack(n, base, low, len(high)) + lows.tobytes() + high.tobytes() + samples.tobytes()


class Sequence:
    """Reads an encoded sequence in place, without a table of all values."""

    def __init__(self, data: bytes):
        self.n, self.base, self.low, size = _HEAD.unpack_from(data)
        raw = np.frombuffer(data, np.uint8, offset=_HEAD.size)
        cut = (self.n * self.low + 7) // 8
        self.lows, self.high = raw[:cut], raw[cut : cut + size]
        self.samples = np.frombuffer(raw[cut + size :].tobytes(), "<u8")

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        return int(self.range(i, i + 1)[0])

    def range(self, i: int, j: int) -> np.ndarray:
        """Values i to j - 1 as int64."""
        if not 0 <= i <= j <= self.n:
            raise IndexError((i, j, self.n))
        if i == j:
            return np.zeros(0, np.int64)
        first = i // SAMPLE
        start = int(self.samples[first]) // 8
        after = (j - 1) // SAMPLE + 1
        stop = int(self.samples[after]) // 8 + 1 if after < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[start:stop], bitorder="little")) + start * 8
        ones = ones[ones >= int(self.samples[first])]
        at = np.arange(i, j)
        top = (ones[i - first * SAMPLE : j - first * SAMPLE] - at).astype(np.uint64) << np.uint64(self.low)
        if self.low:
            a = i * self.low
            b = j * self.low
            bits = np.unpackbits(self.lows[a // 8 : (b + 7) // 8], bitorder="little")[a % 8 :][: b - a]
            weights = np.uint64(1) << np.arange(self.low, dtype=np.uint64)
            top |= (bits.reshape(j - i, self.low).astype(np.uint64) * weights).sum(1, dtype=np.uint64)
        return (top + np.uint64(self.base & (1 << 64) - 1)).view(np.int64)
