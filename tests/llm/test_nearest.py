"""Operators 3 and 6: graph search and exact top-k."""

from __future__ import annotations

import numpy as np
import pytest

from ledgerloom.llm import hnsw, voronoi

SCHEMA = "vec_id long, vector array<float>, rank string, score string, cell string"


def made(n=600, length=8, seed=1):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(n, length)).astype(np.float32)
    points[100:300] = points[100]  # a third are copies of one
    return points


@pytest.fixture(scope="module")
def points():
    return made()


@pytest.fixture(scope="module")
def vectors(spark, points):
    rows = [(i, [float(x) for x in v], "r", "s", "c") for i, v in enumerate(points)]
    odd = [
        (900, None), (901, [0.0] * 8), (902, [float("nan")] + [1.0] * 7), (903, [float("inf")] * 8),
        (904, [None] + [1.0] * 7), (905, []),
    ]
    rows += [(i, v, "r", "s", "c") for i, v in odd]
    return spark.createDataFrame([*rows, rows[7]], SCHEMA).repartition(5)


def asked(vectors):
    return vectors.where("vec_id % 20 = 0 OR vec_id > 899").withColumnRenamed("vec_id", "query_id")


def listed(df):
    rows = df.select("query_id", "rank", "vec_id", "score").collect()
    return sorted(map(tuple, rows))


def nearest(points, k):
    out = {}
    for q in range(0, len(points), 20):
        far = np.sqrt(((points.astype(float) - points[q].astype(float)) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(len(points)), far)) if i != q][:k]
        out[q] = [(int(i), float(far[i])) for i in order]
    return out


@pytest.mark.parametrize("shard", [64, 4096])
def test_graph_search_finds_most_of_the_nearest(vectors, points, monkeypatch, shard):
    monkeypatch.setattr(hnsw, "SHARD", shard)
    found = listed(hnsw.nearest(vectors, asked(vectors), 10))
    expected = nearest(points, 10)
    by_query = {}
    for q, rank, v, score in found:
        by_query.setdefault(q, []).append(v)
        assert rank == len(by_query[q])
        apart = points[q].astype(float) - points[v].astype(float)
        assert score == pytest.approx(np.sqrt((apart**2).sum()), rel=1e-12)
    assert sorted(by_query) == sorted(expected)
    hits = sum(len(set(by_query[q]) & {i for i, _ in best}) for q, best in expected.items())
    assert hits >= 0.95 * 10 * len(expected)
    # Copies: all at distance zero, the smallest ids first.
    assert by_query[120] == [i for i in range(100, 111)][:10]


def test_fewer_candidates_than_asked_for(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, vector array<float>")
    queries = few.where("vec_id = 0").withColumnRenamed("vec_id", "query_id")
    assert listed(hnsw.nearest(few, queries, 10)) == [(0, 1, 2, 0.0), (0, 2, 1, 1.0)]
    assert [r[2] for r in listed(voronoi.top_k(few, queries, 10, 1))] == [1, 2]


def test_no_vectors(vectors):
    none = vectors.limit(0)
    for search in (lambda v, q: hnsw.nearest(v, q, 3), lambda v, q: voronoi.top_k(v, q, 3, 8)):
        assert search(none, asked(vectors)).count() == search(vectors, asked(none)).count() == 0


def test_lengths_must_agree(spark):
    mixed = spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "vec_id long, vector array<float>")
    with pytest.raises(ValueError):
        hnsw.nearest(mixed, asked(mixed), 3)
    with pytest.raises(ValueError):
        voronoi.top_k(mixed, asked(mixed), 3, 8)


def exact(points, k, scale, extra=()):
    whole = {i: np.floor(v.astype(float) * scale).astype(int) for i, v in enumerate(points)}
    whole |= dict(extra)
    out = []
    for q in sorted(whole):
        if q % 20 and q < 900:
            continue
        scores = sorted((-int(whole[q] @ whole[i]), i) for i in whole if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return out


@pytest.mark.parametrize("pivots, block", [(3, 1 << 14), (40, 7), (256, 1 << 14)])
def test_top_k_is_exact(vectors, points, monkeypatch, pivots, block):
    monkeypatch.setattr(voronoi, "PIVOTS", pivots)
    monkeypatch.setattr(voronoi.query_blocks, "__defaults__", (block,))
    found = listed(voronoi.top_k(vectors, asked(vectors), 7, 1024))
    assert found == exact(points, 7, 1024, {901: np.zeros(8, int)}.items())


def test_large_numbers_stay_exact_and_larger_ones_are_refused(spark):
    big = spark.createDataFrame(
        [(0, [3e5, 1.0]), (1, [3e5, 2.0]), (20, [3e5, 3.0])], "vec_id long, vector array<double>"
    )
    queries = big.where("vec_id = 0").withColumnRenamed("vec_id", "query_id")
    scale = 1024
    expected = [(300_000 * scale) ** 2 + scale * scale * n for n in (3, 2)]
    assert [r[3] for r in listed(voronoi.top_k(big, queries, 5, scale))] == expected
    huge = spark.createDataFrame([(0, [1e15]), (1, [1e15])], "vec_id long, vector array<double>")
    with pytest.raises(Exception, match="64 bits"):
        voronoi.top_k(huge, asked(huge), 5, scale).collect()


def test_bounds_hold(points):
    whole = np.floor(points.astype(float) * 64)
    pivots = whole[:10]
    cells = ((whole[:, None] - pivots[None]) ** 2).sum(2).argmin(1)
    far = np.sqrt(((whole - pivots[cells]) ** 2).sum(1))
    size = np.sqrt((whole * whole).sum(1))
    rows = [
        {"cell": c, "n": int((cells == c).sum()), "far": far[cells == c].max(), "size": size[cells == c].max()}
        for c in np.unique(cells)
    ]
    summary = voronoi.Summary(pivots, rows)
    upper, lower = summary.upper(whole), summary.lower(whole)
    scores = whole @ whole.T
    assert (scores <= upper[:, cells]).all() and (scores >= lower[:, cells]).all()
    reach = summary.reached(lower, 10)
    assert (np.sort(scores, axis=1)[:, -10] >= reach).all()
