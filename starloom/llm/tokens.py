"""Vectorised words and window hashes over the bytes of Arrow string columns.

Everything here works on a slice of a record batch at a time, so a task's memory is bounded by the slice and its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
PAD = 8

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_C = np.uint64(0x94D049BB133111EB)
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)


def byte_class(members: bytes | range | list[int]) -> np.ndarray:
    """A 256-entry table that is true for the given bytes."""
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


WHITE_BYTES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
#: Words ``[^\x20\x09-\x0D]+``.
NOT_WHITE = ~byte_class(WHITE_BYTES)
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing: digits, a-z and all that is not ASCII.
LETTERS = byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash; works in place on a fresh array."""
    x ^= x >> np.uint64(30)
    x *= _B
    x ^= x >> np.uint64(27)
    x *= _C
    x ^= x >> np.uint64(31)
    return x


def join_hash(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Hash of two neighbouring sequences, ``n`` words together."""
    x = a * _A
    x += b
    x += np.uint64(n)
    return mix(x)


class Slice:
    """Some whole texts side by side: ``buf`` (padded bytes), ``off`` (byte offsets), words and their hashes."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, first_row: int):
        self.buf, self.off, self.first_row = buf, off, first_row
        self.rows = len(off) - 1

    def find_words(self, members: np.ndarray, lower: bool) -> Slice:
        """Fill ``starts``, ``ends`` (bytes) and ``word_off`` (per text). Texts are borders of words."""
        n = int(self.off[-1])
        if lower:
            self.buf = LOWER[self.buf]
        word = members[self.buf[:n]]
        begins, ends = word.copy(), word.copy()
        if n:
            begins[1:] &= ~word[:-1]
            ends[:-1] &= ~word[1:]
            inner = self.off[1:-1]
            inner = inner[(inner > 0) & (inner < n)]
            begins[inner] = word[inner]
            ends[inner - 1] = word[inner - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.word_off = np.searchsorted(self.starts, self.off)
        return self

    def word_hashes(self, seed: int = 0) -> np.ndarray:
        """64-bit hashes of the words, eight bytes a step; equal words of up to eight bytes never collide with each other."""
        at = np.ndarray((len(self.buf) - PAD + 1,), dtype="<u8", buffer=self.buf.data, strides=(1,))
        length = self.ends - self.starts
        h = at[self.starts] & _MASK[np.minimum(length, 8)]
        h += length.astype(np.uint64) * _A
        h ^= np.uint64(seed)
        mix(h)
        more, k = np.flatnonzero(length > 8), 8
        while more.size:
            x = at[self.starts[more] + k] & _MASK[np.minimum(length[more] - k, 8)]
            x += h[more] * _A
            h[more] = mix(x)
            k += 8
            more = more[length[more] > k]
        return h

    def windows(self, h: np.ndarray, n: int) -> np.ndarray:
        """Hashes of ``n`` words from each word on. Those that leave their text, or the slice, mean nothing: see ``whole``."""
        if n == 1:
            return h
        k = (n + 1) // 2
        left = self.windows(h, k)
        right = left if n - k == k else self.windows(h, n - k)
        out = np.zeros(len(h), dtype=np.uint64)
        if len(h) > k:
            out[:-k] = join_hash(left[:-k], right[k:], n)
        return out

    def whole(self, n: int) -> np.ndarray:
        """Whether ``n`` words from each word on are in its text."""
        last = np.repeat(self.word_off[1:], np.diff(self.word_off))
        return np.arange(len(self.starts)) + n <= last


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """Slices of a string or binary column in row order; null counts as empty. One text is never cut."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32, count=n + 1 + column.offset)[column.offset :].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(off, off[row] + max_bytes, side="right")) - 1)
        buf = np.zeros(off[end] - off[row] + PAD, dtype=np.uint8)
        buf[:-PAD] = raw[off[row] : off[end]]
        yield Slice(buf, off[row : end + 1] - off[row], row)
        row = end
