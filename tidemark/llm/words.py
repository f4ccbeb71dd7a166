"""Hashes of the words of many texts at once, on their bytes."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time; a longer text is worked on alone.
RUN = 1_000_000

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: A byte's value, A-Z as a-z; no value is 0.
VALUE = np.arange(1, 257, dtype=np.uint64)
VALUE[ord("A") : ord("Z") + 1] = VALUE[ord("a") : ord("z") + 1]

BASE = np.uint64(0x9E3779B97F4A7C15)


def give_back() -> None:
    """Return the memory that a task has freed to the system: Python workers are kept for later tasks,
    and what one of them holds is missing to the others of its executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids, bytes and bounds of texts (column 1 of a batch, no nulls), about RUN bytes at a time."""
    texts = batch.column(1).cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + RUN, "right")) - 1)
        bounds = offsets[begin : end + 1]
        yield batch.column(0).slice(begin, end - begin), data[bounds[0] : bounds[-1]], bounds - bounds[0]
        begin = end


def spread_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of words before each text (and after the last)."""
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(starts, bounds)
    if not len(starts):
        return np.empty(0, np.uint64), first
    lengths = stops - starts
    base = np.cumsum(lengths) - lengths
    place = np.arange(base[-1] + lengths[-1]) - np.repeat(base, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), BASE))
    values = VALUE[data[inside]] * powers[place]
    return mixed(np.add.reduceat(values, base) + lengths.astype(np.uint64)), first
