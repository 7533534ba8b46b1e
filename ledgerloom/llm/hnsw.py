"""Approximate nearest neighbours: a navigable small-world graph per shard.

Equal vectors are one node that lists its ids, so that copies cannot crowd each other out
of the graph. Only the ``k + 1`` smallest ids of a vector are listed: ties go to the
smaller id, so no other can be among the ``k`` nearest of any query. Distinct vectors are
dealt to shards of about ``SHARD`` by their hash, whatever the number of copies.

A shard's graph has layers, each with about 1 of ``NEIGHBOURS`` nodes of the layer below.
Nodes enter in seeded order; a node links to near nodes that entered before it, chosen so
that none is nearer to another chosen one than to the node, and they link back, keeping
the best so chosen. A shard is small, so the near nodes are found exactly, by a matrix of
distances. The index is a table with one row per shard: the vectors and, per layer, its
members and one flat array of neighbours with a fixed number of places.

A search enters at the top, goes greedily down to the lowest layer and widens there to
``WIDTH`` candidates; all queries of a block do so side by side. Blocks of queries go to
all shards, each task keeps the best of its shards, and the bests are merged. Scores are
computed from the original vectors in double precision.

Vectors that are null, empty, zero, or hold null or non-finite components take no part;
vectors of several lengths are refused. Repeated rows of an id with one vector count once;
a query id with several vectors uses the smallest. An id is never its own neighbour.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerloom.llm.texts import keys
from ledgerloom.llm.vectors import Best, finite, matrix, one_length, query_blocks
from ledgerloom.staging import stage

SHARD = 4096
NEIGHBOURS = 16  # in the lowest layer twice as many
NEAR = 96  # near nodes among which neighbours are chosen
WIDTH = 128
TOGETHER = 256  # queries searched side by side
SEED = 3

INDEX = "shard long, n int, vectors binary, ids array<array<long>>, members array<binary>, links array<binary>"
NOBODY = -1


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.maximum(d, 0)


def chosen(near: np.ndarray, far: np.ndarray, between: np.ndarray, most: int) -> np.ndarray:
    """Of nodes in order of distance ``far``, those not nearer to one chosen before; then,
    while places are left, the nearest of the others."""
    taken: list[int] = []
    least = np.full(len(near), np.inf)
    for i in range(len(near)):
        if far[i] < least[i]:
            taken.append(i)
            if len(taken) == most:
                break
            np.minimum(least, between[i], out=least)
    if len(taken) < most:
        rest = np.setdiff1d(np.arange(len(near)), taken)
        taken += rest[: most - len(taken)].tolist()
    return near[np.array(taken, int)]


def layer_links(vectors: np.ndarray, most: int) -> np.ndarray:
    """Flat neighbours of the nodes of one layer, which enter in their order."""
    n = len(vectors)
    apart = squared(vectors, vectors)
    links = np.full((n, most), NOBODY, np.int32)
    used = np.zeros(n, int)

    def rechosen(node: int, candidates: np.ndarray) -> None:
        order = candidates[np.lexsort((candidates, apart[node, candidates]))]
        kept = chosen(order, apart[node, order], apart[np.ix_(order, order)], most)
        links[node, : len(kept)], used[node] = kept, len(kept)

    for node in range(1, n):
        row = apart[node, :node]
        if node > NEAR:
            near = np.argpartition(row, NEAR)[:NEAR]
        else:
            near = np.arange(node)
        near = near[np.lexsort((near, row[near]))]
        out = chosen(near, row[near], apart[np.ix_(near, near)], max(1, most // 2))
        links[node, : len(out)], used[node] = out, len(out)
        for other in out.tolist():
            if used[other] < most:
                links[other, used[other]] = node
                used[other] += 1
            else:
                rechosen(other, np.append(links[other], node).astype(np.int64))
    return links


def build(shard: int, vectors: np.ndarray, ids: list) -> dict:
    """The index row of one shard."""
    n = len(vectors)
    chance = (keys(n, SEED) >> np.uint64(11)).astype(float) / 2.0**53
    level = np.floor(-np.log(np.maximum(chance, 1e-12)) / np.log(NEIGHBOURS)).astype(int)
    members, links = [], []
    for layer in range(int(level.max()) + 1):
        own = np.flatnonzero(level >= layer).astype(np.int32)
        most = NEIGHBOURS * (2 if layer == 0 else 1)
        near = layer_links(vectors[own], most)
        members.append(own.tobytes())
        links.append(np.where(near >= 0, own[near], NOBODY).astype(np.int32).tobytes())
    return {
        "shard": shard, "n": n, "vectors": vectors.astype(np.float64).tobytes(),
        "ids": ids, "members": members, "links": links,
    }


def build_index(vectors: DataFrame, k: int) -> DataFrame:
    """The index table of (vec_id, vector); every vector is in it."""
    order = W.partitionBy("vector").orderBy("vec_id")
    few = vectors.distinct().withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    nodes = stage(few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "nodes")
    length = one_length(nodes, "vector")
    shards = max(1, -(-nodes.count() // SHARD))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)))

    def graph(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        found = matrix(table["vector"].combine_chunks(), length, np.float64)
        order = np.argsort([i[0] for i in table["ids"].to_pylist()], kind="stable")
        ids = table["ids"].take(pa.array(order)).to_pylist()
        return pa.Table.from_pylist([build(table["shard"][0].as_py(), found[order], ids)], schema=KINDS)

    return stage(dealt.groupBy("shard").applyInArrow(graph, INDEX), "hnsw")


KINDS = pa.schema(
    [
        ("shard", pa.int64()), ("n", pa.int32()), ("vectors", pa.binary()),
        ("ids", pa.list_(pa.list_(pa.int64()))),
        ("members", pa.list_(pa.binary())), ("links", pa.list_(pa.binary())),
    ]
)


def exact(vectors: np.ndarray, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Squared distances of each query to its own list of nodes."""
    apart = vectors[nodes] - queries[:, None, :]
    return np.einsum("qcd,qcd->qc", apart, apart)


def widen(vectors, links, queries, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best ``width`` nodes of one layer, from the entries given, and their distances."""
    n_queries, n = len(queries), len(vectors)
    seen = np.zeros((n_queries, n + 1), bool)
    every = np.arange(n_queries)
    nodes = np.full((n_queries, width), n)
    far = np.full((n_queries, width), np.inf)
    opened = np.ones((n_queries, width), bool)
    nodes[:, : entry.shape[1]] = entry
    far[:, : entry.shape[1]] = exact(vectors, queries, entry)
    opened[:, : entry.shape[1]] = False
    seen[every[:, None], entry] = True
    seen[:, n] = True
    active = every
    while len(active):
        waiting = np.where(opened[active], np.inf, far[active])
        place = waiting.argmin(1)
        on = np.isfinite(waiting[np.arange(len(active)), place])
        active, place = active[on], place[on]
        if len(active) == 0:
            break
        opened[active, place] = True
        near = links[nodes[active, place]]
        near = np.where(near < 0, n, near)
        fresh = ~seen[active[:, None], near]
        seen[active[:, None], near] = True
        near = np.where(fresh, near, n)
        apart = np.where(fresh, exact(vectors, queries[active], np.minimum(near, n - 1)), np.inf)
        all_far = np.concatenate([far[active], apart], 1)
        order = np.argpartition(all_far, width - 1, axis=1)[:, :width]
        far[active] = np.take_along_axis(all_far, order, 1)
        nodes[active] = np.take_along_axis(np.concatenate([nodes[active], near], 1), order, 1)
        done = np.concatenate([opened[active], ~fresh], 1)
        opened[active] = np.take_along_axis(done, order, 1)
    return nodes, far


def search(row: dict, length: int, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Nodes found for each query in one shard, their distances, and the shard's ids."""
    n = row["n"]
    vectors = np.frombuffer(row["vectors"]).reshape(n, length)
    members = [np.frombuffer(m, np.int32) for m in row["members"]]
    layers = []
    for own, raw in zip(members, row["links"], strict=True):
        flat = np.frombuffer(raw, np.int32).reshape(len(own), -1)
        links = np.full((n + 1, flat.shape[1]), NOBODY, np.int32)
        links[own] = flat
        layers.append(links)
    found = []
    for a in range(0, len(queries), TOGETHER):
        some = queries[a : a + TOGETHER]
        entry = np.full((len(some), 1), members[-1][0])
        for links in reversed(layers[1:]):
            nodes, far = widen(vectors, links, some, entry, 1)
            entry = nodes[:, :1]
        found.append(widen(vectors, layers[0], some, entry, min(WIDTH, n)))
    return *[np.concatenate(x) for x in zip(*found, strict=True)], row["ids"]


def nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found of each query.

    ``vectors`` has vec_id and vector, ``queries`` has query_id and vector.
    """
    spark = vectors.sparkSession
    usable = stage(vectors.where(finite(F.col("vector")) & F.exists("vector", lambda x: x != 0)), "vectors")
    asking = queries.where(finite(F.col("vector")) & F.exists("vector", lambda x: x != 0))
    asking = stage(asking.groupBy("query_id").agg(F.min("vector").alias("vector")), "queries")
    schema = "query_id long, vec_id long, score double"
    if usable.isEmpty() or asking.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = build_index(usable, k)
    length = one_length(usable.select("vector").union(asking.select("vector")), "vector")
    merged = None
    for ids, column in query_blocks(asking, "vector"):
        points = matrix(column, length, np.float64)
        part = index.mapInArrow(searcher(ids, points, length, k), schema)
        best = stage(top(part, k), "nearest")
        merged = best if merged is None else merged.union(best)
    return merged


def top(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def searcher(ids: np.ndarray, points: np.ndarray, length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(ids), k, np.inf)
        everyone = np.arange(len(ids))
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                nodes, far, listed = search(row, length, points)
                # A place for each of the k + 1 smallest ids of a node.
                deep = max(map(len, listed))
                table = np.full((len(listed) + 1, deep), np.iinfo(np.int64).max)
                for node, some in enumerate(listed):
                    table[node, : len(some)] = some
                few = np.argsort(far, axis=1, kind="stable")[:, : 2 * (k + 1)]
                nodes, far = np.take_along_axis(nodes, few, 1), np.take_along_axis(far, few, 1)
                offered = table[nodes].reshape(len(ids), -1)
                scores = np.repeat(np.sqrt(far), deep, axis=1)
                own = offered == ids[:, None]
                none = own | (offered == np.iinfo(np.int64).max)
                best.offer(everyone, np.where(none, np.inf, scores), np.where(none, np.iinfo(np.int64).max, offered))
        rows, scores, vec_ids = best.found()
        yield pa.record_batch(
            [pa.array(ids[rows]), pa.array(vec_ids), pa.array(scores)], names=["query_id", "vec_id", "score"]
        )

    return run
