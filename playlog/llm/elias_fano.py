"""Elias-Fano codes of non-decreasing integers, with sampled select.

A value splits into ``low`` bits, stored packed, and a high part, stored in
unary: the i-th value sets bit (high_i + i) of a bit array. About
2 + log2(universe / n) bits a value. ``select`` finds the i-th set bit from a
sample of every 256th, so any value is read without decoding the rest.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<qqBq")  # count, first value, low bits, bits of the unary array
_EVERY = 256


def encode(values: np.ndarray) -> bytes:
    """Bytes of a non-decreasing int64 array."""
    v = np.asarray(values, np.int64)
    n = len(v)
    if not n:
        return _HEAD.pack(0, 0, 0, 0)
    rel = (v.view(np.uint64) - v.view(np.uint64)[0])
    spread = int(rel[-1])
    low = max(0, (spread // n).bit_length() - 1)
    high = (rel >> np.uint64(low)).astype(np.int64) + np.arange(n)
    size = int(high[-1]) + 1
    unary = np.zeros(-(-size // 8) * 8, np.uint8)
    unary[high] = 1
    lows = np.zeros((n, low), np.uint8)
    for b in range(low):
        lows[:, b] = (rel >> np.uint64(b)) & np.uint64(1)
    sample = high[::_EVERY].astype("<u4" if size <= 0xFFFFFFFF else "<u8")
    return b"".join([_HEAD.pack(n, int(v[0]), low, size), sample.tobytes(),
                     np.packbits(lows.ravel(), bitorder="little").tobytes(),
                     np.packbits(unary, bitorder="little").tobytes()])


class Reader:
    """Random access to an encoded sequence at ``offset`` of ``data``."""

    def __init__(self, data: bytes, offset: int = 0):
        self.n, self.first, self.low, size = _HEAD.unpack_from(data, offset)
        at = offset + _HEAD.size
        wide = "<u4" if size <= 0xFFFFFFFF else "<u8"
        k = -(-self.n // _EVERY)
        self.sample = np.frombuffer(data, wide, k, at)
        at += self.sample.nbytes
        self.lows = np.frombuffer(data, np.uint8, -(-self.n * self.low // 8), at)
        at += len(self.lows)
        self.unary = np.frombuffer(data, np.uint8, -(-size // 8), at)
        self.end = at + len(self.unary)

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """Place of the i-th set bit, scanning from the sample before it."""
        at = int(self.sample[i // _EVERY])
        left = i % _EVERY
        byte = at >> 3
        head = int(self.unary[byte]) >> (at & 7)
        if head.bit_count() > left:
            return at + _nth(head, left)
        left -= head.bit_count()
        while True:
            byte += 1
            b = int(self.unary[byte])
            if b.bit_count() > left:
                return byte * 8 + _nth(b, left)
            left -= b.bit_count()

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = self.select(i) - i << self.low
        for b in range(self.low):
            k = i * self.low + b
            value |= (int(self.lows[k >> 3]) >> (k & 7) & 1) << b
        return _wrap(self.first + value)

    def all(self) -> np.ndarray:
        """Every value, decoded at once."""
        if not self.n:
            return np.zeros(0, np.int64)
        high = np.flatnonzero(np.unpackbits(self.unary, bitorder="little"))[:self.n] - np.arange(self.n)
        rel = high.astype(np.uint64) << np.uint64(self.low)
        bits = np.unpackbits(self.lows, bitorder="little", count=self.n * self.low).reshape(self.n, self.low)
        for b in range(self.low):
            rel |= bits[:, b].astype(np.uint64) << np.uint64(b)
        return (rel + np.array([self.first], np.int64).view(np.uint64)).view(np.int64)


def _nth(byte: int, i: int) -> int:
    """Place of the i-th set bit of a byte."""
    for _ in range(i):
        byte &= byte - 1
    return (byte & -byte).bit_length() - 1


def _wrap(x: int) -> int:
    return (x + (1 << 63)) % (1 << 64) - (1 << 63)
