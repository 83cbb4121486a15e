"""Elias-Fano coding of a rising sequence, with random access by a select directory.

``n`` values below ``u`` take about ``2 + log2(u / n)`` bits each: the low bits
lie packed side by side, the high bits are unary in a bit vector with a one per
value. The directory holds the place of every 256th one as a 32-bit distance
from the one 65536 ones before; only those, one in 65536, take 64 bits.
"""

from __future__ import annotations

import struct

import numpy as np

EVERY = 256
BLOCK = 65536
_HEAD = struct.Struct("<4sBxxxQQQQQ")
_MAGIC = b"EFv1"
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def _packed(values: np.ndarray, bits: int) -> bytes:
    """The lowest ``bits`` of each value, side by side."""
    if not bits or not len(values):
        return b""
    out = []
    step = 1 << 16  # a multiple of 8, so that every part ends at a whole byte
    shifts = np.arange(bits, dtype=np.uint64)
    for a in range(0, len(values), step):
        cells = (values[a : a + step, None] >> shifts) & np.uint64(1)
        out.append(np.packbits(cells.astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(out)


def encode(values: np.ndarray) -> bytes:
    """A rising sequence of unsigned 64-bit numbers; equal neighbours are allowed, a fall is an error."""
    values = np.asarray(values, dtype=np.uint64)
    n = len(values)
    if n and (values[1:] < values[:-1]).any():
        raise ValueError("values must not fall")
    top = int(values[-1]) if n else 0
    bits = max(0, (top // n).bit_length() - 1) if n else 0
    ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
    size = int(ones[-1]) + 1 if n else 0
    high = np.zeros((size + 7) // 8, dtype=np.uint8)
    if n:
        np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
    blocks = ones[::BLOCK]
    samples = (ones[::EVERY] - np.repeat(blocks, BLOCK // EVERY)[: -(-n // EVERY)]) if n else ones
    if n and samples.max() >= 2**32:
        raise ValueError("a gap leaves the 32-bit directory")
    low = _packed(values, bits)
    head = _HEAD.pack(_MAGIC, bits, n, len(low), len(high), len(blocks), len(samples))
    return head + blocks.astype("<u8").tobytes() + samples.astype("<u4").tobytes() + low + high.tobytes()


class EliasFano:
    """Reads an encoded sequence in place: ``self[i]`` by select, ``values()`` all at once."""

    def __init__(self, data: bytes | memoryview):
        magic, self.bits, self.n, low, high, blocks, samples = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not an Elias-Fano sequence")
        at = _HEAD.size
        self.blocks = np.frombuffer(data, "<u8", blocks, at)
        at += 8 * blocks
        self.samples = np.frombuffer(data, "<u4", samples, at)
        at += 4 * samples
        self.low = np.frombuffer(data, np.uint8, low, at)
        self.high = np.frombuffer(data, np.uint8, high, at + low)
        self.size = at + low + high

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """Place of the one of value ``i`` in the high bits."""
        place = int(self.blocks[i // BLOCK]) + int(self.samples[i // EVERY])
        left = i % EVERY
        byte = place >> 3
        word = int(self.high[byte]) >> (place & 7) << (place & 7)
        while True:
            held = int(_ONES[word])
            if held > left:
                break
            left -= held
            byte += 1
            word = int(self.high[byte])
        for bit in range(8):
            if word >> bit & 1:
                if not left:
                    return 8 * byte + bit
                left -= 1
        raise AssertionError("unreachable")

    def _low(self, i: int) -> int:
        first = i * self.bits
        cell = int.from_bytes(self.low[first >> 3 : (first + self.bits + 7) >> 3].tobytes(), "little")
        return cell >> (first & 7) & ((1 << self.bits) - 1)

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        return (self.select(i) - i) << self.bits | self._low(i)

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.bits)
        step = 1 << 16
        for a in range(0, self.n if self.bits else 0, step):
            rows = min(step, self.n - a)
            cells = np.unpackbits(self.low[a * self.bits // 8 :], count=rows * self.bits, bitorder="little").reshape(rows, self.bits)
            out[a : a + rows] |= (cells.astype(np.uint64) << np.arange(self.bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return out

    def before(self, value: int) -> int:
        """How many values are below ``value``."""
        first, last = 0, self.n
        while first < last:
            middle = (first + last) // 2
            if self[middle] < value:
                first = middle + 1
            else:
                last = middle
        return first
