"""Vectorised word tables over Arrow string columns.

A word is a maximal run of bytes other than space and \\t..\\r, that is
``[^\\x20\\x09-\\x0D]+``.  All arrays are built with numpy over the UTF-8 bytes of
many texts at once, a few megabytes at a time, so that memory stays bounded by
the chunk size and the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer single text makes a chunk of its own.
CHUNK_BYTES = 1 << 20

_M = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n.  Those for usual chunks are kept per worker, longer ones are not."""
    got = _powers.get(base)
    if got is None or len(got[0]) < n:
        size = max(n, CHUNK_BYTES + 64)
        up, down = np.empty(size, np.uint64), np.empty(size, np.uint64)
        up[0] = down[0] = 1
        up[1:], down[1:] = base & _M, pow(base, -1, 1 << 64)
        got = (np.multiply.accumulate(up, out=up), np.multiply.accumulate(down, out=down))
        if size <= 4 * CHUNK_BYTES:
            _powers[base] = got
    return got[0][:n], got[1][:n]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """A hash of codes[start:end] for each span, equal for equal contents anywhere."""
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = powers(base, len(codes) + 1)
    total = np.empty(len(codes) + 1, np.uint64)
    total[0] = 0
    np.cumsum(codes * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and the offsets (length n + 1) of a string column; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents with about `size` bytes each."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j
        i = j


class Words:
    """Word spans of the texts data[offsets[d]:offsets[d + 1]]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SEPARATOR):
        inside = ~separator[data]
        full = offsets[:-1] < offsets[1:]
        before, after = np.empty_like(inside), np.empty_like(inside)
        if len(data):
            before[0], after[-1] = False, False
            before[1:], after[:-1] = inside[:-1], inside[1:]
            before[offsets[:-1][full]] = False
            after[offsets[1:][full] - 1] = False
        self.data = data
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        #: words of document d are first[d] .. first[d + 1]
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def docs(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        return span_hashes(_BYTE_CODE[self.data], self.starts, self.ends)


def windows(codes: np.ndarray, length: int, base: int = _BASE) -> np.ndarray:
    """The hash of codes[i:i + length] for every i."""
    n = max(0, len(codes) - length + 1)
    at = np.arange(n)
    return span_hashes(codes, at, at + length, base)


def sliding(x: np.ndarray, width: int, best=np.minimum) -> np.ndarray:
    """best over x[i:i + width] for every i, by doubling."""
    if len(x) < width:
        return x[:0]
    n, have, y = len(x) - width + 1, 1, x
    while 2 * have <= width:
        y = best(y[: len(y) - have], y[have:])
        have *= 2
    return y[:n] if have == width else best(y[:n], y[width - have : width - have + n])
