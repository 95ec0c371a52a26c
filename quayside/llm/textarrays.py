"""Word spans and hashes of a whole Arrow column at once, as numpy arrays.

A column's texts lie one after the other in one UTF-8 buffer. Everything here works on that buffer in slices of whole
texts, so memory follows the slice, or the longest text where that is longer.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

#: Space, tab, line feed, vertical tab, form feed, carriage return.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_RANDOM = np.random.default_rng(20_240_601)
_BYTE_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_SHINGLE = _RANDOM.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass
class Slice:
    """Texts `first` to `first + count - 1` of a column: their bytes and where each begins and ends."""

    first: int
    count: int
    data: np.ndarray
    offsets: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The column in runs of whole texts of about `limit` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        stop = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        stop = min(max(stop, first + 1), len(column))
        own = bounds[first : stop + 1]
        yield Slice(first, stop - first, whole[own[0] : own[-1]], own - own[0])
        first = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    """Words of a slice: byte spans, the text each lies in, and per text the first word (one more at the end)."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)


def words(part: Slice) -> Words:
    """Maximal runs of bytes other than white space, never across texts."""
    n = len(part.data)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, none, np.zeros(part.count + 1, dtype=np.int64))
    space = IS_SPACE[part.data]
    before = np.empty(n, dtype=bool)
    before[0] = True
    before[1:] = space[:-1]
    after = np.empty(n, dtype=bool)
    after[-1] = True
    after[:-1] = space[1:]
    inner = part.offsets[(part.offsets > 0) & (part.offsets < n)]
    before[inner] = True
    after[inner - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    bounds = np.searchsorted(starts, part.offsets, side="left")
    text = np.repeat(np.arange(part.count), np.diff(bounds))
    return Words(starts, ends, text, bounds)


def word_hashes(part: Slice, found: Words) -> np.ndarray:
    """64-bit hash of each word: random values of its bytes, weighted by powers of an odd base."""
    if not len(found):
        return np.zeros(0, dtype=np.uint64)
    lengths = found.ends - found.starts
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    powers = np.cumprod(np.full(int(lengths.max()) + 1, _BASE, dtype=np.uint64))
    values = _BYTE_VALUE[part.data[~IS_SPACE[part.data]]]
    values *= powers[place]
    return mix(np.add.reduceat(values, firsts) + lengths.astype(np.uint64))


def windows(hashes: np.ndarray, found: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of `width` words within a text, and the index of its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(found.text[:n] == found.text[width - 1 :])
    total = np.zeros(len(at), dtype=np.uint64)
    for k in range(width):
        total += hashes[at + k] * _SHINGLE[k]
    return mix(total), at


try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _TRIM = None


def release() -> None:
    """Hand freed memory back to the system: a Python worker lives on after its task, and others need the memory."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def released(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, with memory handed back after the work on each."""
    for batch in batches:
        yield batch
        release()
