"""Elias-Fano coding of non-decreasing integers (Elias 1974, Fano 1971): n values up to u take about
n * (2 + log2(u / n)) bits. The lower bits of every value are packed; the upper parts are a bit vector with a one for
each value, at upper part + index. A directory of every STEP-th one makes `select` look at one short stretch.
"""

from __future__ import annotations

import struct

import numpy as np

STEP = 256
HEAD = struct.Struct("<QBQ")          # number of values, lower bits, bytes of the upper bit vector
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def encode(values: np.ndarray) -> bytes:
    v = np.asarray(values, np.uint64)
    n = len(v)
    if n == 0:
        return HEAD.pack(0, 0, 0)
    low = max(0, (int(v[-1]) // n).bit_length() - 1)
    upper = (v >> np.uint64(low)) + np.arange(n, dtype=np.uint64)
    bits = np.zeros(int(upper[-1]) + 1, np.uint8)
    bits[upper.astype(np.int64)] = 1
    packed = np.packbits(bits, bitorder="little")
    shifts = np.arange(low, dtype=np.uint64)
    lower = np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
    return HEAD.pack(n, low, len(packed)) + packed.tobytes() + upper[::STEP].astype("<u4").tobytes() + lower.tobytes()


class Reader:
    def __init__(self, raw: bytes):
        self.n, self.low, size = HEAD.unpack_from(raw)
        at = HEAD.size
        self.upper = np.frombuffer(raw, np.uint8, size, at)
        at += size
        self.directory = np.frombuffer(raw, "<u4", -(-self.n // STEP), at)
        self.lower = np.frombuffer(raw, np.uint8, -(-self.n * self.low // 8), at + 4 * len(self.directory))

    def select(self, i: int) -> int:
        """The i-th value, from the stretch of the upper bits after the directory's entry."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.directory[i // STEP]), i % STEP
        byte = at >> 3
        here = int(self.upper[byte]) >> (at & 7) << (at & 7)
        while _ONES[here] <= left:
            left -= int(_ONES[here])
            byte += 1
            here = int(self.upper[byte])
        for _ in range(left):
            here &= here - 1
        place = (byte << 3) + (here & -here).bit_length() - 1
        low = 0
        if self.low:
            first = i * self.low
            end = first + self.low
            word = int.from_bytes(self.lower[first >> 3: (end + 7) >> 3].tobytes(), "little")
            low = (word >> (first & 7)) & ((1 << self.low) - 1)
        return (place - i) << self.low | low

    def all(self) -> np.ndarray:
        if self.n == 0:
            return np.zeros(0, np.uint64)
        ones = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[: self.n].astype(np.uint64)
        high = (ones - np.arange(self.n, dtype=np.uint64)) << np.uint64(self.low)
        if not self.low:
            return high
        bits = np.unpackbits(self.lower, count=self.n * self.low, bitorder="little").reshape(self.n, self.low)
        return high | (bits.astype(np.uint64) << np.arange(self.low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
