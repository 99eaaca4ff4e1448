"""Vectorised text kernels that run inside Arrow batches.

Every kernel takes the bytes of several texts at once and needs memory in
proportion to them, so callers cut a batch into slices of ``SLICE_BYTES`` with
``slices``; a longer text forms a slice of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_c = ctypes.CDLL(None)

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_RANDOM = np.random.default_rng(20240607)
_BYTE_CODE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD_STEP = 0xD1342543DE82EF95
_powers = {}


def powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count-1) modulo 2**64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < count:
        factors = np.full(max(count, 4096), base, dtype=np.uint64)
        factors[0] = 1
        have = _powers[base] = np.multiply.accumulate(factors)
    return have[:count]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit sums over all their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer else np.zeros(0, np.uint8)
    return data, offsets


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``first`` to ``last`` (exclusive) with their bytes and offsets from zero."""
    if len(column) == 0:
        return
    data, offsets = buffers(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def release() -> None:
    """Give freed memory back to the system; workers stay alive between tasks and would hold it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_c, "malloc_trim", None)
    if trim is not None:  # only in glibc
        trim(0)


class Words:
    """Words of several texts: maximal runs of bytes other than ASCII white space.

    ``hashes`` has one 64-bit hash per word; words ``first[i]`` to ``first[i + 1]``
    belong to text i, and ``start`` and ``end`` are their places among the bytes.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        count = len(data)
        inside = ~WHITE[data]
        opening = inside.copy()
        opening[1:] &= ~inside[:-1]
        edges = offsets[:-1][offsets[:-1] < count]
        opening[edges] = inside[edges]
        closing = inside.copy()
        closing[:-1] &= ~inside[1:]
        ends = offsets[1:][offsets[1:] > 0] - 1
        closing[ends] = inside[ends]
        self.start = np.flatnonzero(opening)
        self.end = np.flatnonzero(closing) + 1
        self.first = np.searchsorted(self.start, offsets)
        if len(self.start) == 0:
            self.hashes = np.zeros(0, dtype=np.uint64)
            return
        lengths = self.end - self.start
        place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        letters = data[inside]
        codes = _BYTE_CODE[LOWER[letters] if lower else letters]
        codes *= powers(int(_STEP), int(lengths.max()))[place]
        self.hashes = mix(np.add.reduceat(codes, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))


def window_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words of one text."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    base = (_WORD_STEP + 2 * seed * 0x632BE59BD9B4E019) % (1 << 64) | 1
    weights = powers(base, len(words))
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.add.accumulate(words * weights, out=sums[1:])
    inverse = pow(base, -1, 1 << 64)
    return mix((sums[size:] - sums[:count]) * powers(inverse, count))


def signed(values: np.ndarray) -> pa.Array:
    """Unsigned hashes as Spark's long."""
    return pa.array(values.view(np.int64))
