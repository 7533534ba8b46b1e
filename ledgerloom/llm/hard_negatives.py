"""Hard negatives by angular triangle filtering.

An anchor's positives are the rows of its label with the highest scores; its hard
negatives, for each positive, the best rows of other labels whose score lies in a window
below the positive's. Scores are inner products of whole numbers.

``REFERENCES`` directions are chosen from a bounded sample so that most of it lies close to
one, and every row is stored with its angles to all of them. For an anchor and a row, the
angles a and b to one direction bound the angle between the two: at least |a - b|, at most
the smaller of a + b and the rest of the circle. That is an interval of cosines; times the
two norms it is an interval of scores, widened by more than its rounding error. Rows are
sorted by label, nearest direction and angle, and taken ``TILE`` at a time. The interval of
a whole tile comes from the least and largest angles and norms in it; where it meets no
window of an anchor, the tile is passed over for that anchor. For the anchors that are
left each row's own interval is taken from its nearest direction and the anchor's. Only
the rows and anchors whose intervals meet a window get integer scores. A window's lower end
rises to the last of its best rows so far.

Anchors go to the rows in blocks of ``BLOCK``, one after the other, once for the positives
and once for the negatives; the driver holds the references and one block. A label that
most rows have is dealt out like any other, as rows are dealt by ranges of angles.

Rows with a null label or vector, an empty vector, or a null or non-finite component take
no part. Zero vectors do; their score with anything is 0. Vectors of several lengths are
refused, as are scores beyond 64 bits. Equal rows count once. An id with several rows may
be hit once by each; as an anchor it is its smallest row. A row is no hit of an anchor with
its id. Other columns are ignored. Nothing usable, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.vectors import finite, matrix, one_length, query_blocks
from ledgerloom.llm.voronoi import products, whole
from ledgerloom.staging import stage

REFERENCES, SAMPLE, SEED = 16, 2048, 41
TILE, BLOCK = 256, 8192
# More than an angle or a cosine made here can be off.
SLACK = 1e-6
LEAST = np.iinfo(np.int64).min
FOUND = "anchor_id long, place int, vec_id long, score long"


def directions(sample: np.ndarray) -> np.ndarray:
    """Unit vectors out of the sample, one after the other: each brings most of it closer."""
    norms = np.sqrt((sample * sample).sum(1))
    units = sample[norms > 0] / norms[norms > 0][:, None]
    if len(units) == 0:
        return np.eye(1, sample.shape[1])
    near = units @ units.T
    best, chosen = np.full(len(units), -1.0), []
    for _ in range(min(REFERENCES, len(units))):
        gain = np.maximum(near - best, 0).sum(1)
        chosen.append(int(gain.argmax()))
        best = np.maximum(best, near[chosen[-1]])
    return units[sorted(set(chosen))]


def angles(rows: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles of rows to all references, and their norms; a zero vector is at right angles."""
    rows = rows.astype(np.float64)
    norms = np.sqrt((rows * rows).sum(1))
    cosines = (rows @ references.T) / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosines, -1, 1)), norms


def stored_angles(references: np.ndarray) -> Column:
    """Of a column ``v``: its angles, its norm, its nearest direction and the angle to that."""
    length = references.shape[1]

    @F.arrow_udf("angles array<double>, norm double, cell int, own double")
    def made(column: pa.Array) -> pa.Array:
        found, norms = angles(matrix(column, length, np.int64), references)
        bounds = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
        cell = found.argmin(1) if len(found) else np.zeros(0, np.int64)
        listed = pa.ListArray.from_arrays(bounds, found.ravel())
        values = [listed, pa.array(norms), pa.array(cell.astype(np.int32)), pa.array(found[np.arange(len(found)), cell])]
        return pa.StructArray.from_arrays(values, ["angles", "norm", "cell", "own"])

    return made(F.col("v"))


def scores_between(low: np.ndarray, high: np.ndarray, size: np.ndarray, least: np.ndarray, most: np.ndarray):
    """Score bounds from bounds of the cosine and of the row's norm, widened."""
    low, high = np.maximum(low - SLACK, -1), np.minimum(high + SLACK, 1)
    under = size * low * np.where(low >= 0, least, most)
    over = size * high * np.where(high >= 0, most, least)
    return under - 1e-9 * np.abs(under) - 1, over + 1e-9 * np.abs(over) + 1


def tile_bounds(mine: np.ndarray, size: np.ndarray, tile: np.ndarray, norms: np.ndarray):
    """Bounds of the scores of each anchor (angles ``mine``, norm ``size``) in a tile."""
    first, last = tile.min(0), tile.max(0)
    least = np.maximum(np.maximum(mine - last, first - mine), 0).max(1)
    beyond = np.where(mine + first >= np.pi, 2 * np.pi - mine - first, np.pi)
    most = np.where(mine + last <= np.pi, mine + last, beyond).min(1)
    return scores_between(np.cos(most), np.cos(least), size, norms.min(), norms.max())


def row_bounds(mine: np.ndarray, size: np.ndarray, tile: np.ndarray, norms: np.ndarray):
    """Bounds of the scores of each anchor and row, by the row's nearest direction and the anchor's.

    cos(a - b) and cos(a + b) are the sum and the difference of two products.
    """
    low, high = np.full((len(mine), len(tile)), -1.0), np.full((len(mine), len(tile)), 1.0)
    for r in np.union1d(tile.argmin(1), mine.argmin(1)):
        along = np.outer(np.cos(mine[:, r]), np.cos(tile[:, r]))
        across = np.outer(np.sin(mine[:, r]), np.sin(tile[:, r]))
        np.maximum(low, along - across, out=low)
        np.minimum(high, along + across, out=high)
    return scores_between(low, high, size[:, None], norms[None], norms[None])


class Kept:
    """The best ``k`` rows of each window so far; ``bar`` is what a further one must reach."""

    def __init__(self, low: np.ndarray, k: int):
        self.k, self.bar = k, low.copy()
        self.none = [np.zeros(0, np.int64)] * 3
        self.offers, self.n = [self.none], 0
        self.limit = max(200_000, 4 * k * low.size)

    def offer(self, window: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        self.offers.append([window, score, vec_id])
        self.n += len(window)
        if self.n > self.limit:
            self.thin_out()

    def thin_out(self) -> list[np.ndarray]:
        window, score, vec_id = (np.concatenate(x) for x in zip(*self.offers, strict=True))
        order = np.lexsort((vec_id, -score, window))
        window, score, vec_id = window[order], score[order], vec_id[order]
        place = np.arange(len(window)) - np.searchsorted(window, window)
        full = place == self.k - 1
        self.bar.ravel()[window[full]] = score[full]
        kept = place < self.k
        self.offers, self.n = [[window[kept], score[kept], vec_id[kept]]], int(kept.sum())
        return self.offers[0]


class Search:
    """One block of anchors with their windows, against rows.

    ``low`` and ``high`` (anchor, place) are ends of score windows, both included; a window
    with low above high is none. ``same`` tells whether rows of the anchor's label are
    wanted or all others. ``scored`` counts the pairs that got an integer score.
    """

    def __init__(self, ids, labels, points, references, low, high, k: int, same: bool):
        self.ids, self.labels, self.points, self.references = ids, labels, points, references
        self.low, self.high, self.k, self.same = low, high, k, same
        self.scored = 0

    def tile(self, kept: Kept, vec_ids, labels, rows, tile, norms) -> None:
        wanted = np.isin(self.labels, labels) if self.same else np.ones(len(self.ids), bool)
        least, most = kept.bar.min(1), self.high.max(1)
        asking = np.flatnonzero(wanted)
        under, over = tile_bounds(self.mine[asking], self.size[asking], tile, norms)
        asking = asking[(over >= least[asking]) & (under <= most[asking])]
        if len(asking) == 0:
            return
        under, over = row_bounds(self.mine[asking], self.size[asking], tile, norms)
        fits = (over >= least[asking, None]) & (under <= most[asking, None])
        fits &= (self.labels[asking, None] == labels[None]) == self.same
        fits &= self.ids[asking, None] != vec_ids[None]
        some, columns = fits.any(1), np.flatnonzero(fits.any(0))
        asking, fits = asking[some], fits[some][:, columns]
        if len(asking) == 0:
            return
        self.scored += fits.size
        scores = products(self.points[asking], rows[columns])
        for place in range(self.low.shape[1]):
            inside = fits & (scores >= kept.bar[asking, place, None]) & (scores <= self.high[asking, place, None])
            a, c = np.nonzero(inside)
            kept.offer(asking[a] * self.low.shape[1] + place, scores[a, c], vec_ids[columns[c]])

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Best rows of every window among rows (vec_id, label, v, angles, norm)."""
        self.mine, self.size = angles(self.points, self.references)
        kept = Kept(self.low, self.k)
        for batch in batches:
            vec_ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            rows = matrix(batch.column(2), self.points.shape[1], np.int64)
            found = matrix(batch.column(3), len(self.references), np.float64)
            norms = batch.column(4).to_numpy(zero_copy_only=False)
            for a in range(0, batch.num_rows, TILE):
                cut = slice(a, a + TILE)
                self.tile(kept, vec_ids[cut], labels[cut], rows[cut], found[cut], norms[cut])
        window, score, vec_id = kept.thin_out()
        anchor, place = np.divmod(window, self.low.shape[1])
        columns = [self.ids[anchor], place.astype(np.int32), vec_id, score]
        yield pa.record_batch([pa.array(c) for c in columns], names=["anchor_id", "place", "vec_id", "score"])


def windows(scores: np.ndarray, given: np.ndarray, low_pct: int, high_pct: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole scores s with low_pct * p <= 100 s <= high_pct * p, for each positive's score p.

    The products are taken apart, so that none exceeds 64 bits.
    """
    below, rest = np.divmod(scores, 100)
    low = low_pct * below - (-(low_pct * rest) // 100)
    high = high_pct * below + high_pct * rest // 100
    return np.where(given, low, 1), np.where(given, high, 0)


def best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``vectors`` has vec_id, label and vector; ``anchors`` tells which rows are anchors.
    ``window`` is in hundredths of the positive's score, both ends included.
    """
    spark = vectors.sparkSession
    usable = vectors.where(finite(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        whole(F.col("vector"), scale).alias("v"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
    )
    data = stage(usable.distinct(), "usable")
    asking = data.where("is_anchor").groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("label", "v")).alias("row"))
    kind = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if asking.isEmpty():
        return spark.createDataFrame([], kind)
    length = one_length(data, "v")
    drawn = data.select("v").distinct().orderBy(F.xxhash64("v", F.lit(SEED)), "v").limit(SAMPLE)
    references = directions(matrix(drawn.toArrow().column(0).combine_chunks(), length, np.float64))
    placed = data.withColumn("at", stored_angles(references)).select("vec_id", "label", "v", "at.*")
    sorted_ = placed.repartitionByRange("label", "cell", "own").sortWithinPartitions("label", "cell", "own")
    rows = stage(sorted_, "rows").select("vec_id", "label", "v", "angles", "norm")
    made = None
    for ids, column in query_blocks(asking, "row", BLOCK):
        labels = column.field("label").to_numpy(zero_copy_only=False)
        points = matrix(column.field("v"), length, np.int64)
        block = ids, labels, points, references
        everything = np.full((len(ids), 1), LEAST), np.full((len(ids), 1), -LEAST - 1)
        search = Search(*block, *everything, positives, True)
        ranked = best(rows.mapInArrow(search.run, FOUND), positives)
        chosen = stage(
            ranked.select(
                "anchor_id",
                (F.col("rank") - 1).alias("place"),
                F.col("vec_id").alias("positive_id"),
                F.col("score").alias("positive_score"),
            ),
            "positives",
        )
        scores, given = np.zeros((len(ids), positives), np.int64), np.zeros((len(ids), positives), bool)
        known = chosen.select("anchor_id", "place", "positive_score").toArrow()
        by_id = np.argsort(ids)
        at = by_id[np.searchsorted(ids, known.column(0).to_numpy(), sorter=by_id)]
        place = known.column(1).to_numpy()
        scores[at, place], given[at, place] = known.column(2).to_numpy(), True
        search = Search(*block, *windows(scores, given, *window), negatives, False)
        hard = best(rows.mapInArrow(search.run, FOUND), negatives)
        pairs = hard.join(chosen, ["anchor_id", "place"]).select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
        part = stage(pairs, "pairs")
        made = part if made is None else made.union(part)
    return made
