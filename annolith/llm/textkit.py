"""Words and shingles of Arrow text columns as numpy arrays, without a Python object per word."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
SHINGLE_BASE = U64(0xD6E8FEB86659FD93)
#: Words hashed at once, few enough for a core's cache.
AT_ONCE = 1 << 16
#: Masks that keep the first 0 to 8 bytes of a little-endian load.
KEPT_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)

#: A-Z to a-z, all else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: The blanks of the word pattern [^\x20\x09-\x0D]+.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII but letters parts words.
NO_LETTER = np.ones(256, bool)
NO_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = np.asarray(x, U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    out = np.full(n, base, U64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=U64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, end to end, and the n + 1 offsets of the texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a column: ``start``, ``end`` are byte places, ``first[i]:first[i + 1]`` the words of text i."""

    def __init__(self, column: pa.Array, blank: np.ndarray = BLANK):
        self.data, self.offsets = utf8(column)
        inside = ~blank[self.data]
        begins = np.zeros(len(self.data) + 1, bool)
        begins[self.offsets] = True
        starts, ends = inside.copy(), inside.copy()
        if len(inside):
            starts[1:] &= ~inside[:-1] | begins[1:-1]
            ends[:-1] &= ~inside[1:] | begins[1:-1]
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.blank = blank

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self, most: int | None = None) -> np.ndarray:
        """A 64-bit hash for each word, A-Z lower-cased; of its first ``most`` bytes, if given."""
        low = np.zeros(len(self.data) + 8, np.uint8)
        low[:-8] = LOWER[self.data]
        loads = np.ndarray((len(self.data) + 1,), "<u8", buffer=low.data, strides=(1,))
        out = np.empty(len(self.start), U64)
        for k in range(0, len(out), AT_ONCE):
            start = self.start[k : k + AT_ONCE]
            size = self.end[k : k + AT_ONCE] - start
            if most is not None:
                size = np.minimum(size, most)
            h = mix(size.astype(U64) * SHINGLE_BASE ^ (loads[start] & KEPT_BYTES[np.minimum(size, 8)]))
            left = np.flatnonzero(size > 8)
            place = 8
            while len(left):
                block = loads[start[left] + place] & KEPT_BYTES[np.minimum(size[left] - place, 8)]
                h[left] = mix(h[left] * BASE ^ block)
                place += 8
                left = left[size[left] > place]
            out[k : k + AT_ONCE] = h
        return out


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words within each text (with fewer words, of all of them), and their n + 1 bounds."""
    counts = np.diff(first)
    sizes = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(bounds[-1], U64)
    if len(hashes) >= width:
        rolled = np.zeros(len(hashes) - width + 1, U64)
        for k, p in enumerate(powers(width, SHINGLE_BASE)):
            rolled += hashes[k : k + len(rolled)] * p
        long_enough = np.repeat(counts >= width, sizes)
        begin = np.repeat(first[:-1] - bounds[:-1], sizes) + np.arange(bounds[-1])
        out[long_enough] = rolled[begin[long_enough]]
    table = powers(width, SHINGLE_BASE)
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        own = hashes[first[i] : first[i + 1]]
        out[bounds[i]] = (own * table[: len(own)]).sum(dtype=U64) + U64(len(own))
    return mix(out), bounds


def shingle_sets(column: pa.Array, width: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its word shingles."""
    words = Words(column)
    hashed, bounds = shingle_hashes(words.hashes(), words.first, width)
    return [np.unique(hashed[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def fold(ids, folds: int = 5) -> np.ndarray:
    """crc32(id as text) mod folds; null ids count as empty text."""
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % folds for i in ids], np.int64)


def release() -> None:
    """Give freed memory back to the system: idle workers stay for a while, and would keep what their last task took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, or of one row whose text is longer; memory follows the longest text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        mark = np.cumsum(size) // most
        cuts = [0, *(np.flatnonzero(np.diff(mark)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
    release()
