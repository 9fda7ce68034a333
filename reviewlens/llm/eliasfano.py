"""Non-decreasing integers in near-minimal space with access by position.

n values up to u take about 2 + log2(u / n) bits each: the low bits of every
value stand side by side, the high parts are the gaps between set bits of a bit
vector (Elias 1974, Fano 1971).  The position of every ``STEP``-th set bit is
kept as a 32-bit number, so ``select`` looks at one stretch of the vector.
"""

from __future__ import annotations

import struct

import numpy as np

STEP = 256
_HEAD = struct.Struct("<QQB")


def encode(values: np.ndarray) -> bytes:
    """Bytes of a non-decreasing sequence of integers from 0 up."""
    values = np.asarray(values, np.uint64)
    n, top = len(values), int(values[-1]) if len(values) else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    bits = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    high = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    vector = np.zeros(int(high[-1]) + 1 if n else 0, np.uint8)
    vector[high] = 1
    parts = [
        _HEAD.pack(n, len(vector), low),
        np.packbits(bits.ravel(), bitorder="little").tobytes(),
        np.packbits(vector, bitorder="little").tobytes(),
        high[::STEP].astype("<u4").tobytes(),
    ]
    return b"".join(parts)


class Sequence:
    """Reads values of an encoded sequence without decoding the rest."""

    def __init__(self, data: bytes):
        self.n, size, self.low = _HEAD.unpack_from(data)
        at = _HEAD.size
        ends = np.cumsum([at, -(-self.n * self.low // 8), -(-size // 8), 4 * -(-self.n // STEP)])
        self.lower = np.frombuffer(data, np.uint8, int(ends[1] - ends[0]), int(ends[0]))
        self.upper = np.frombuffer(data, np.uint8, int(ends[2] - ends[1]), int(ends[1]))
        self.samples = np.frombuffer(data, "<u4", -(-self.n // STEP), int(ends[2]))
        self.nbytes = int(ends[3])

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Values at positions start to stop."""
        stop = min(stop, self.n)
        if start >= stop:
            return np.zeros(0, np.int64)
        block = start // STEP
        begin = int(self.samples[block]) // 8
        after = -(-stop // STEP)
        end = int(self.samples[after]) // 8 + 1 if after < len(self.samples) else len(self.upper)
        ones = np.flatnonzero(np.unpackbits(self.upper[begin:end], bitorder="little")) + 8 * begin
        ones = ones[ones >= int(self.samples[block])][start - block * STEP :][: stop - start]
        high = ones.astype(np.int64) - np.arange(start, stop)
        if not self.low:
            return high
        first, last = start * self.low, stop * self.low
        bits = np.unpackbits(self.lower[first // 8 : -(-last // 8)], bitorder="little")
        bits = bits[first % 8 :][: last - first].reshape(-1, self.low).astype(np.int64)
        return (high << self.low) | (bits << np.arange(self.low)).sum(axis=1)

    def select(self, k: int) -> int:
        """The value at position k."""
        return int(self.slice(k, k + 1)[0])
