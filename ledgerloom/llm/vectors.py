"""Helpers of the two vector searches: usable vectors, blocks of queries, running bests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.staging import stage

# Queries that one job carries to all data: bounds what the driver and a task hold.
QUERY_BLOCK = 1 << 14


def finite(vector: Column) -> Column:
    """Whether a vector is there, not empty, and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def one_length(vectors: DataFrame, column: str) -> int:
    """The length of all vectors; vectors of several lengths are refused."""
    row = vectors.agg(F.min(F.size(column)), F.max(F.size(column))).first()
    if row[0] != row[1]:
        raise ValueError(f"vectors of {row[0]} and of {row[1]} components")
    return row[0] or 0


def matrix(column: pa.Array, length: int, kind) -> np.ndarray:
    """A list column as rows of numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(kind, copy=False).reshape(-1, length)


def query_blocks(queries: DataFrame, column: str, block: int = QUERY_BLOCK) -> Iterator[tuple[np.ndarray, list]]:
    """Ids and vectors of the queries, about ``block`` at a time; one block is held at once."""
    n = queries.count()
    blocks = -(-n // block)
    dealt = stage(queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(max(blocks, 1)))), "queries")
    for i in range(blocks):
        rows = dealt.where(F.col("block") == i).select("query_id", column).toArrow()
        if rows.num_rows:
            yield rows.column(0).to_numpy(), rows.column(1).combine_chunks()


class Best:
    """The best ``k`` of each query so far: smallest key first, ties to the smaller id."""

    def __init__(self, n: int, k: int, worst):
        self.k, self.worst = k, worst
        self.keys = np.full((n, k), worst)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def offer(self, rows: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> None:
        """Candidates ``keys`` and ``ids`` (row, candidate) for the queries ``rows``."""
        keys = np.concatenate([self.keys[rows], keys], axis=1)
        ids = np.concatenate([self.ids[rows], ids], axis=1)
        order = np.lexsort((ids, keys), axis=1)[:, : self.k]
        self.keys[rows] = np.take_along_axis(keys, order, 1)
        self.ids[rows] = np.take_along_axis(ids, order, 1)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query rows, keys and ids of everything found."""
        rows, places = np.nonzero(self.ids != np.iinfo(np.int64).max)
        return rows, self.keys[rows, places], self.ids[rows, places]
