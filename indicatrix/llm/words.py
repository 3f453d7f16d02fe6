"""Words of many texts at once: bounds and 64-bit hashes, as numpy arrays over an Arrow text column.

A word is a longest run of bytes outside ``\\x20\\x09-\\x0D``. A hash is a polynomial over random byte values modulo 2^64,
taken from prefix sums, so that no loop over words or bytes runs in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\v\f\r"
CHUNK_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


class Hasher:
    """Hashes of the spans of a sequence, with tables kept between calls."""

    def __init__(self, seed: int = 1, lower: bool = False):
        self.base = (BASE * (2 * seed + 1)) | 3
        self.base %= 1 << 64
        self.values = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if lower:
            self.values[65:91] = self.values[97:123]
        self.up = self.down = np.ones(1, np.uint64)

    def _tables(self, n: int) -> None:
        if len(self.up) < n:
            self.up = powers(self.base, n)
            self.down = powers(pow(self.base, -1, 1 << 64), n)

    def spans(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for each span."""
        self._tables(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.down[starts])

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.spans(self.values[data], starts, ends)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow text column; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data, (offsets - offsets[0]) if len(offsets) else offsets


def chunks(data: np.ndarray, offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole texts in runs of about ``size`` bytes: first text, last text (exclusive), bytes, offsets."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    table = np.ones(256, bool)
    table[list(SPACES)] = False
    word = table[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | cut[1:-1]
    last[:-1] &= ~word[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_column(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words at such bounds as an Arrow text column."""
    table = np.ones(256, bool)
    table[list(SPACES)] = False
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[table[data]]))])
