"""Exact top-k by inner product of whole numbers, as a Voronoi join.

Pivots, at most ``PIVOTS`` vectors with the smallest hashes, divide data and queries into
cells of what is nearest to each. A cell's summary is its size, its radius (the largest
distance from its pivot) and its largest length. For a group of queries in one cell and a
cell of data these bound every score from both sides; the sizes of the cells with the
highest lower bounds give a score that the ``k`` best of every query in the group reach,
and only cells whose upper bound reaches it are read for the group. The data lie sorted
by cell, so a block of groups reads the row groups it needs. Inside a task the same bounds
are taken per query, against the score of the query's ``k`` best so far.

Only summaries, pivots and one block of queries at a time are on the driver, all of fixed
size. A cell that holds most of the data is cut among tasks by id like any other.

Scores are exact: products go through floating point only if no sum can exceed 2**53, and
through 64-bit numbers if none can exceed those; larger vectors are refused. Bounds are
widened by more than their rounding error.

Vectors that are null, empty, or hold null or non-finite components take no part; zero
vectors do. Vectors of several lengths are refused. Repeated rows of an id with one vector
count once; a query id with several vectors uses the smallest. An id is never its own hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerloom.llm.vectors import Best, finite, matrix, one_length, query_blocks
from ledgerloom.staging import stage

PIVOTS = 256
SEED = 29
FILES = 64
EXACT, LARGEST = 2**53, 2**63 - 1
NOTHING = np.iinfo(np.int64).max
WIDER = 1e-9
# Queries and rows that are scored at once; a task holds a few tables of that size.
TOGETHER, ROWS = 1024, 2048


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component x as a double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def nearest_pivot(pivots: np.ndarray) -> Column:
    """Cell of a column ``v``, its distance from the pivot, and its length."""
    length = pivots.shape[1]

    @F.arrow_udf("cell int, far double, size double")
    def cell(column: pa.Array) -> pa.Array:
        rows = matrix(column, length, np.float64)
        near = (pivots * pivots).sum(1)[None] - 2 * (rows @ pivots.T)
        cells = near.argmin(1)
        far = np.sqrt(((rows - pivots[cells]) ** 2).sum(1))
        values = [cells.astype(np.int32), far, np.sqrt((rows * rows).sum(1))]
        return pa.StructArray.from_arrays([pa.array(v) for v in values], ["cell", "far", "size"])

    return cell(F.col("v"))


class Summary:
    """What is known of each cell of the data."""

    def __init__(self, pivots: np.ndarray, rows: list):
        n = len(pivots)
        self.pivots = pivots
        self.count, self.radius, self.longest = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        for r in rows:
            self.count[r["cell"]], self.radius[r["cell"]] = r["n"], r["far"]
            self.longest[r["cell"]] = r["size"]

    def upper(self, points: np.ndarray, apart: float = 0.0) -> np.ndarray:
        """Most that a query within ``apart`` of each point scores in each cell."""
        return self.bound(points, apart, 1)

    def lower(self, points: np.ndarray, apart: float = 0.0) -> np.ndarray:
        return self.bound(points, apart, -1)

    def bound(self, points: np.ndarray, apart: float, sign: int) -> np.ndarray:
        middle = points @ self.pivots.T
        length = np.sqrt((points * points).sum(1))[:, None]
        of_pivot = np.sqrt((self.pivots * self.pivots).sum(1))[None]
        slack = length * self.radius + apart * of_pivot + apart * self.radius
        by_length = (length + apart) * self.longest
        slack += WIDER * (length + apart) * (of_pivot + self.radius) + 1
        if sign > 0:
            return np.minimum(middle + slack, by_length * (1 + WIDER) + 1)
        return np.maximum(middle - slack, -by_length * (1 + WIDER) - 1)

    def reached(self, lower: np.ndarray, k: int) -> np.ndarray:
        """A score that the k best of each row reach, by the sizes of the best cells."""
        some = np.flatnonzero(self.count)
        order = np.argsort(-lower[:, some], axis=1)
        held = np.cumsum(self.count[some][order], axis=1)
        sorted_ = np.take_along_axis(lower[:, some], order, 1)
        enough = held >= k
        place = enough.argmax(1)
        found = sorted_[np.arange(len(lower)), place]
        return np.where(enough.any(1), found, -np.inf)


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * queries.shape[1]
    if bound < EXACT:
        return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    if bound < LARGEST:
        return queries @ rows.T
    raise ValueError("scores do not fit 64 bits")


def solver(ids: np.ndarray, points: np.ndarray, summary: Summary, k: int):
    """Best k of a block of queries among the rows a task reads."""
    length = points.shape[1]
    upper = summary.upper(points.astype(np.float64))

    def best_of_tile(tile: np.ndarray, rows: np.ndarray, named: np.ndarray) -> tuple:
        scores = -products(points[tile], rows)
        scores[named[None] == ids[tile][:, None]] = NOTHING
        order = np.argsort(scores, axis=1, kind="stable")[:, :k]
        keys = np.take_along_axis(scores, order, 1)
        return keys, np.where(keys == NOTHING, NOTHING, named[order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(ids), k, NOTHING)
        floor = summary.reached(summary.lower(points.astype(np.float64)), k + 1)
        for batch in batches:
            cells = batch.column(0).to_numpy(zero_copy_only=False)
            vec_ids = batch.column(1).to_numpy(zero_copy_only=False)
            rows = matrix(batch.column(2), length, np.int64)
            for cell in np.unique(cells):
                asking = np.flatnonzero(upper[:, cell] >= floor)
                own = np.flatnonzero(cells == cell)
                # Of equal scores the smaller id goes first: rows are in that order.
                own = own[np.argsort(vec_ids[own], kind="stable")]
                for a in range(0, len(own), ROWS):
                    some = own[a : a + ROWS]
                    for b in range(0, len(asking), TOGETHER):
                        tile = asking[b : b + TOGETHER]
                        best.offer(tile, *best_of_tile(tile, rows[some], vec_ids[some]))
                full = best.ids[:, -1] != NOTHING
                floor = np.where(full, np.maximum(floor, -best.keys[:, -1].astype(np.float64)), floor)
        rows, keys, found = best.found()
        yield pa.record_batch(
            [pa.array(ids[rows]), pa.array(found), pa.array(-keys)], names=["query_id", "vec_id", "score"]
        )

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int, scale: int) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` highest scores of each query.

    ``vectors`` has vec_id and vector, ``queries`` has query_id and vector.
    """
    spark = vectors.sparkSession
    data = vectors.where(finite(F.col("vector"))).select("vec_id", whole(F.col("vector"), scale).alias("v"))
    data = stage(data.distinct(), "whole")
    asking = queries.where(finite(F.col("vector"))).select("query_id", whole(F.col("vector"), scale).alias("v"))
    asking = stage(asking.groupBy("query_id").agg(F.min("v").alias("v")), "asking")
    if data.isEmpty() or asking.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    length = one_length(data.select("v").union(asking.select("v")), "v")
    chosen = data.select("v").distinct().orderBy(F.xxhash64("v", F.lit(SEED)), "v").limit(PIVOTS)
    pivots = np.array([r["v"] for r in chosen.collect()], np.float64)
    placed = data.withColumn("at", nearest_pivot(pivots)).select("vec_id", "v", "at.*")
    cut = placed.repartitionByRange(FILES, "cell", "vec_id").sortWithinPartitions("cell", "vec_id")
    cells = stage(cut, "cells")
    rows = cells.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("far").alias("far"), F.max("size").alias("size")
    ).collect()
    summary = Summary(pivots, rows)
    merged = None
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    for ids, column in query_blocks(asking, "v"):
        points = matrix(column, length, np.int64)
        needed = group_cells(points.astype(np.float64), summary, k)
        read = cells.where(F.col("cell").isin(needed)).select("cell", "vec_id", "v")
        part = read.mapInArrow(solver(ids, points, summary, k), "query_id long, vec_id long, score long")
        ranked = part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best = stage(ranked.select("query_id", "rank", "vec_id", "score"), "best")
        merged = best if merged is None else merged.union(best)
    return merged


def group_cells(points: np.ndarray, summary: Summary, k: int) -> list[int]:
    """The cells that some group of the queries needs."""
    near = (summary.pivots * summary.pivots).sum(1)[None] - 2 * (points @ summary.pivots.T)
    group = near.argmin(1)
    needed = np.zeros(len(summary.pivots), bool)
    for g in np.unique(group):
        own = points[group == g]
        middle = summary.pivots[g][None]
        apart = float(np.sqrt(((own - middle) ** 2).sum(1)).max())
        reach = summary.reached(summary.lower(middle, apart), k + 1)[0]
        needed |= summary.upper(middle, apart)[0] >= reach
    return np.flatnonzero(needed & (summary.count > 0)).tolist()
