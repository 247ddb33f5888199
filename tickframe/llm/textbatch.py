"""Vectorised word and hash helpers over Arrow text batches, used inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64


def _trim() -> Callable[[int], int]:
    try:
        return ctypes.CDLL(None).malloc_trim
    except AttributeError:  # another C library
        return lambda _: 0


def lean(run: Callable) -> Callable:
    """The task function, handing memory that it no longer uses back to the system after every batch.

    Python workers live on after a task, several to an executor, and the allocators of Arrow and C keep what was freed.
    """

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim = _trim()
        for out in run(batches):
            yield out
            del out
            pa.default_memory_pool().release_unused()
            trim(0)
        pa.default_memory_pool().release_unused()
        trim(0)

    return task


def lean_group(run: Callable) -> Callable:
    """The same for a function of one group's batches."""

    @wraps(run)
    def task(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return lean(lambda rows: run(key, rows))(batches)

    return task


#: Bytes of text handled at once; a longer document is handled whole, alone.
SLICE_BYTES = 1 << 19

_SPACE = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
#: Byte tables: a word byte is anything but white space, or a digit, letter or non-ASCII byte.
NOT_SPACE = np.array([b not in _SPACE for b in range(256)])
WORD_CHARS = np.array([b >= 0x80 or chr(b).isdigit() or chr(b).isalpha() for b in range(256)])

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def byte_values(fold_case: bool) -> np.ndarray:
    """A random-looking 64-bit value per byte; with ``fold_case`` A-Z share those of a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15))
    if fold_case:
        values[65:91] = values[97:123]
    return values


_FOLDED, _PLAIN = byte_values(True), byte_values(False)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE, np.uint64)]))
            self.down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, pow(_BASE, -1, 1 << 64), np.uint64)]))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def prefix_sums(data: np.ndarray, fold_case: bool = True) -> np.ndarray:
    """Running polynomial hash of bytes; ``substring_hash`` takes differences of it."""
    return running_hash((_FOLDED if fold_case else _PLAIN)[data])


def running_hash(values: np.ndarray) -> np.ndarray:
    """The same of characters that have a 64-bit value each."""
    up, _ = _POWERS.to(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums


def substring_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each data[start:end], equal for equal content wherever it lies."""
    _, down = _POWERS.to(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


#: Words of so many bytes are hashed by their bytes: the polynomial hash has known collisions from 1,024 bytes on.
LONG_WORD = 512


def word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool = True) -> np.ndarray:
    """64-bit hash of each word data[start:end], A-Z lower-cased with ``fold_case``; words in ascending order.

    The running hash is kept for ``SLICE_BYTES`` of the data at a time, whatever the length of a text.
    """
    found, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + SLICE_BYTES)))
        low, high = starts[i], min(ends[j - 1], starts[j - 1] + LONG_WORD)
        sums = prefix_sums(data[low:high], fold_case)
        found[i:j] = substring_hash(sums, starts[i:j] - low, np.minimum(ends[i:j], high) - low)
        i = j
    for i in np.flatnonzero(ends - starts >= LONG_WORD):
        raw = data[starts[i] : ends[i]].tobytes()
        found[i] = xxhash.xxh3_64_intdigest(raw.lower() if fold_case else raw)
    return found


def to_bytes_array(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a text column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None and column.buffers()[2].size else np.zeros(0, np.uint8)
    return data, offsets


def slices(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``limit`` bytes: (first row, end row, their bytes, offsets from 0)."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, n)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the number of words before it (rows + 1 numbers)."""
    inside = table[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        cuts = offsets[1:-1]
        before[cuts[cuts < len(data)]] = False
        after[cuts[cuts > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def pack_planes(values: np.ndarray) -> bytes:
    """int64 values as differences by byte plane, which stream compression shrinks well."""
    steps = np.diff(values, prepend=np.int64(0)).astype(np.int64)
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_planes(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())
