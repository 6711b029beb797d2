"""Whole columns of text as numpy arrays: words, hashes of words and of windows of words.

A word is a maximal run of bytes other than \\x20 and \\x09-\\x0D, so no multi-byte character is cut.
A column is worked through in slices of whole texts of about SLICE bytes, so that the arrays stay
small whatever the batch; a text longer than that is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard

SLICE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits of x."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(8)
def _powers(base: int, log_n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full((1 << log_n) + 1, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of an odd base and of its inverse, modulo 2 ** 64."""
    return _powers(int(base), max(12, int(n).bit_length()))


def texts(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows (one more than rows); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(offsets: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` bytes."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = b


class Words:
    """The words of some texts: first and end byte of each, and per text the range of its words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        self.n_docs = len(offsets) - 1
        if n:
            solid = ~_SPACE[data]
            edge = np.zeros(n + 1, bool)
            edge[offsets] = True
            begin = solid.copy()
            begin[1:] &= ~solid[:-1] | edge[1:n]
            end = solid.copy()
            end[:-1] &= ~solid[1:] | edge[1:n]
            self.start, self.end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        else:
            self.start = self.end = np.zeros(0, np.int64)
        self.first = np.searchsorted(self.start, offsets)  # of each text, and the number of all at the end
        self.n = len(self.start)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), np.diff(self.first))

    def hashes(self, seed: int = 0) -> np.ndarray:
        return mix(spans(self.data, self.start, self.end), seed)


def spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64 = _BASE) -> np.ndarray:
    """A 64-bit hash of each data[start:end]."""
    p, q = powers(base, len(data))
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[: len(data)], out=h[1:])
    return (h[end] - h[start]) * q[start] + (end - start).astype(np.uint64)


def windows(values: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each values[i:i + size], for i up to len(values) - size."""
    n = len(values)
    if n < size:
        return np.zeros(0, np.uint64)
    p, q = powers(_STEP, n)
    h = np.zeros(n + 1, np.uint64)
    np.cumsum(values * p[:n], out=h[1:])
    return mix((h[size:] - h[:-size]) * q[: n - size + 1], seed)


def whole(values: np.ndarray, first: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each values[first[i]:first[i + 1]] and its length."""
    p, q = powers(_STEP, len(values))
    h = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * p[: len(values)], out=h[1:])
    return mix((h[first[1:]] - h[first[:-1]]) * q[first[:-1]] + np.diff(first).astype(np.uint64), seed)


def inside(first: np.ndarray, size: int) -> np.ndarray:
    """Numbers of the words at which a window of `size` words lies in one text."""
    n = np.maximum(np.diff(first) - size + 1, 0)
    return ranges(first[:-1], n)


def ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (n[0] numbers), then the same from start[1], and so on."""
    total = int(n.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(n) - n
    return np.repeat(start - before, n) + np.arange(total)


_PACK, _UNPACK = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(a: np.ndarray) -> bytes:
    """Numbers as compressed bytes: all first bytes, then all second bytes, and so on."""
    a = np.ascontiguousarray(a)
    return _PACK.compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes())


def unpack(b, dtype) -> np.ndarray:
    raw = np.frombuffer(_UNPACK.decompress(b), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).reshape(-1)


def pack_sorted(a: np.ndarray) -> bytes:
    d = a.copy()
    d[1:] -= a[:-1]
    return pack(d)


def unpack_sorted(b) -> np.ndarray:
    return np.cumsum(unpack(b, np.uint64), dtype=np.uint64)


def member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether each x is among the sorted values."""
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    i = np.searchsorted(sorted_values, x)
    i[i == len(sorted_values)] = 0
    return sorted_values[i] == x
