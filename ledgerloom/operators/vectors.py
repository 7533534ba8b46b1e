"""Vector search: the most similar vectors by cosine, without approximation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ranking import TaskBest, best, steps_of
from ledgerloom.staging import stage, stage_all

# Numbers sent to the tasks at a time (64 MB as doubles), and scores computed
# at a time.
SENT_NUMBERS = 8_000_000
CELLS = 2_000_000


def directions(column) -> np.ndarray:
    """Rows scaled to length 1; a zero vector gives NaN, which never ranks."""
    rows = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype("float64")
    rows = rows.reshape(len(column), -1) if len(column) else rows.reshape(0, 1)
    with np.errstate(invalid="ignore", divide="ignore"):
        return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def cosine_scorer(query_ids: np.ndarray, queries: np.ndarray, k: int):
    """A function for ``mapInArrow``: vectors in, their best per query out.

    Each product is summed by itself, in the order of the components, so that a score
    does not depend on what else is in the block.
    """
    n_rows = max(1, CELLS // len(query_ids))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = TaskBest(len(query_ids), k)
        for batch in batches:
            for start in range(0, batch.num_rows, n_rows):
                part = batch.slice(start, n_rows)
                found.offer(
                    steps_of(np.einsum("qd,nd->qn", queries, directions(part.column("embedding")))),
                    part.column("vec_id").to_numpy(),
                )
        kept = found.thin_out()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(query_ids[kept["query"].to_numpy(dtype=int)], pa.int64()),
                pa.array(kept["item"].to_numpy(), pa.int64()),
                pa.array(kept["steps"].to_numpy(dtype="int64"), pa.int64()),
            ],
            names=["query_id", "vec_id", "steps"],
        )

    return score


def centroids(vectors: DataFrame, group: str) -> DataFrame:
    """``(query_id, embedding)``: the mean vector of each value of ``group``.

    Means are taken per position, so a group of any size is only ever partial
    sums.
    """
    return (
        vectors.select(F.col(group).cast("bigint").alias("query_id"), F.posexplode("embedding"))
        .groupBy("query_id", "pos")
        .agg(F.avg(F.col("col").cast("double")).alias("mean"))
        .groupBy("query_id")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "mean"))).alias("cells"))
        .select("query_id", F.col("cells.mean").alias("embedding"))
    )


def search_vectors(
    queries: DataFrame, vectors: DataFrame, k: int = 5, sent_numbers: int = SENT_NUMBERS
) -> DataFrame:
    """``(query_id, embedding)`` against ``(vec_id, embedding)`` ->
    ``(query_id, rank, vec_id, score)``.

    Each task multiplies its vectors with all queries and passes on its ``k``
    best per query: the vectors are neither shuffled nor paired with queries as
    rows. Queries are counted first and sent in pieces of bounded size, one after
    the other, with one scan of the vectors each. Ids are whole numbers. Vectors
    and queries of several lengths are refused; null and empty ones, and vectors
    of zeros, have no cosine and take no part.
    """
    asked = stage(queries.where(F.size("embedding") > 0), "queries")
    shape = asked.agg(
        F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim"),
        F.min(F.size("embedding")).alias("least"),
    ).first()
    if shape["n"] and shape["least"] != shape["dim"]:
        raise ValueError("query vectors differ in length")
    spark = asked.sparkSession
    answers = "query_id long, vec_id long, steps long"
    if not shape["n"]:
        return best(spark.createDataFrame([], answers), "query_id", "vec_id", k).select(
            "query_id", "rank", "vec_id", "score"
        )
    dim = shape["dim"]
    fitting = vectors.where(F.size("embedding") > 0).select("vec_id", "embedding")
    other = fitting.where(F.size("embedding") != dim).select("vec_id").first()
    if other:
        raise ValueError(f"vector {other[0]} differs in length from the queries")
    per_piece = max(1, sent_numbers // (2 * dim))
    n_pieces = -(-shape["n"] // per_piece)

    def found() -> Iterator[DataFrame]:
        yield spark.createDataFrame([], answers)
        for i in range(n_pieces):
            piece = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(n_pieces)) == i).toArrow()
            if piece.num_rows:
                scorer = cosine_scorer(
                    piece.column("query_id").to_numpy(),
                    directions(piece.column("embedding").combine_chunks()),
                    k,
                )
                yield fitting.mapInArrow(scorer, answers)

    return best(stage_all(found(), "scored"), "query_id", "vec_id", k).select("query_id", "rank", "vec_id", "score")
