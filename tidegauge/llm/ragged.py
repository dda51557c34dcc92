"""Texts of an Arrow column as flat arrays: pieces of many texts in one pass.

A piece (a word, a pre-token) is a start and an end in the bytes of a chunk of texts.
Pieces are known by a 64-bit hash of their bytes, so that what depends on the piece
alone is worked out once per different piece and remembered by the worker.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that are handled at once; a longer text makes a chunk of its own.
CHUNK = 1 << 21
# Remembered pieces of a worker; past it the memory starts anew.
REMEMBERED = 1 << 21

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(
    1, 2 ** 64, 256, dtype=np.uint64, endpoint=False)
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[ord("A"):ord("Z") + 1] += 32


def mixed(values: np.ndarray) -> np.ndarray:
    """The values with all bits spread (in a new array)."""
    values = values ^ (values >> U64(30))
    values *= U64(0xBF58476D1CE4E5B9)
    values ^= values >> U64(27)
    values *= U64(0x94D049BB133111EB)
    values ^= values >> U64(31)
    return values


class _Powers:
    """Powers of the base and of its inverse, as many as the longest chunk needed."""

    up = down = np.ones(1, U64)

    @classmethod
    def get(cls, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < count:
            size = max(count, CHUNK + 1)
            cls.up, cls.down = (np.cumprod(np.concatenate(
                [np.ones(1, U64), np.full(size - 1, base, U64)])) for base in
                (_BASE, pow(_BASE, -1, 2 ** 64)))
        return cls.up, cls.down


def chunks(texts: pa.Array, most: int = CHUNK
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, bounds); text i has bytes bounds[i]:bounds[i+1].
    A null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        bounds = offsets[first:last + 1]
        yield first, last, data[bounds[0]:bounds[-1]], bounds - bounds[0]
        first = last


def words(data: np.ndarray, bounds: np.ndarray, between: np.ndarray = WHITE
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the words between certain bytes, ASCII white space
    if not said otherwise."""
    inside = ~between[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, text_of(starts, bounds)


def text_of(starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.searchsorted(bounds[:-1], starts, "right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each piece's bytes, the same wherever it stands."""
    up, down = _Powers.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    weighted = _BYTE[data]
    weighted *= down[:len(data)]
    np.cumsum(weighted, out=sums[1:])
    found = sums[ends]
    found -= sums[starts]
    found *= up[starts]
    found += (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93)
    return mixed(found)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys, the first place of each, and which of them each key is."""
    coded = pa.array(keys).dictionary_encode()
    which = coded.indices.to_numpy(zero_copy_only=False)
    places = np.empty(len(coded.dictionary), np.int64)
    places[which[::-1]] = np.arange(len(keys) - 1, -1, -1)
    return coded.dictionary.to_numpy(zero_copy_only=False), places, which


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` one after another."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return flat[:0]
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])]


def release() -> None:
    """Give memory that is free but kept by the allocators back to the system, as a worker
    does before it waits for its next task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


class Memory:
    """What a worker found out about pieces: a row of numbers per hash."""

    def __init__(self, limit: int = REMEMBERED):
        self.limit = limit
        self.keys, self.rows = np.empty(0, U64), None

    def get(self, keys: np.ndarray, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Rows of different ``keys``; ``work`` makes those of the numbers it is given."""
        places = np.searchsorted(self.keys, keys)
        known = places < len(self.keys)
        known[known] = self.keys[places[known]] == keys[known]
        missing = np.flatnonzero(~known)
        if self.rows is None or len(missing):
            made = work(missing)
            if self.rows is None:
                self.rows = made[:0]
            out = np.empty((len(keys), *made.shape[1:]), made.dtype)
            out[missing] = made
            out[known] = self.rows[places[known]]
            if len(self.keys) + len(missing) > self.limit:
                self.keys, self.rows = np.empty(0, U64), made[:0]
                places = np.zeros(len(keys), np.int64)
            order = missing[np.argsort(keys[missing])]
            self.keys = np.insert(self.keys, places[order], keys[order])
            self.rows = np.insert(self.rows, places[order], out[order], axis=0)
            return out
        return self.rows[places]
