"""Arrow string columns as numpy arrays, inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

# ASCII white space that separates words: space and the controls 9 to 13.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True

U64 = np.uint64

# Rows that Spark gives a task's Python at once; texts may be long.
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Make Spark hand texts to Python in batches of few rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def give_back() -> None:
    """Return freed memory to the system. Python workers outlive their task, and several
    share an executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and where each text begins and ends in it.

    Null is an empty text.
    """
    whole = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(whole, pa.ChunkedArray):
        whole = whole.combine_chunks()
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    if len(whole) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(whole) + 1, np.int64)
    data = np.frombuffer(whole.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(texts: pa.Array, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about so many bytes each, at least one row.

    Bounds what a task holds at once; every row is in one range and is whole.
    """
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at, n = 0, len(sizes)
    while at < n:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
        yield at, to
        at = to


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and the number of the first word of each text.

    A word is a run without ASCII white space; none crosses from a text into the next.
    """
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~IS_SPACE[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    opens[cuts] = inside[cuts]
    closes[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix finaliser)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def keys(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix((np.arange(1, n + 1, dtype=U64) + U64(seed)) * U64(0x9E3779B97F4A7C15))


def ranges_within(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of all ranges, one after the other, and where each range begins."""
    first = np.cumsum(lengths) - lengths
    total = int(first[-1] + lengths[-1]) if len(lengths) else 0
    return np.arange(total) + np.repeat(starts - first, lengths), first


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of the bytes of each span, the same wherever the span stands. None is empty."""
    if len(starts) == 0:
        return np.zeros(0, U64)
    lengths = ends - starts
    where, first = ranges_within(starts, lengths)
    place = np.arange(len(where)) - np.repeat(first, lengths)
    weight = keys(int(lengths.max()), seed)
    products = (data[where].astype(U64) + U64(1)) * weight[place]
    return mix(np.add.reduceat(products, first) + lengths.astype(U64))
