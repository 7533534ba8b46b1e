from __future__ import annotations

import numpy as np
import pytest

from ledgerloom.operators.vectors import centroids, search_vectors

SCHEMA = "vec_id bigint, label int, embedding array<float>"


@pytest.fixture(scope="module")
def rows():
    """Vectors of which a third are copies of one, plus a zero, an empty and a null one."""
    rng = np.random.default_rng(3)
    made = rng.normal(size=(120, 8)).astype("float32")
    made = np.concatenate([made, np.repeat(made[:1], 60, axis=0)])
    full = [(i, i % 4, [float(x) for x in v]) for i, v in enumerate(made)]
    return [*full, (900, 0, [0.0] * 8), (901, 0, []), (902, 0, None)]


@pytest.fixture(scope="module")
def vectors(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5, "vec_id").cache()


def brute_force(queries, rows, k):
    out = []
    for q, v in queries:
        v = np.asarray(v, dtype="float64")
        scores = []
        for i, _, w in rows:
            w = np.zeros(0) if w is None else w
            w = np.asarray(w, dtype="float64")
            if len(w) == len(v) and np.linalg.norm(w) and np.linalg.norm(v):
                cos = float(v @ w / np.linalg.norm(v) / np.linalg.norm(w))
                scores.append((-np.floor((np.floor(cos * 1e12 + 0.5) + 500_000) / 1e6) / 1e6, i))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("k, sent", [(5, 8_000_000), (100, 8_000_000), (5, 64)])
def test_equals_brute_force(spark, vectors, rows, k, sent):
    queries = [(i, v) for i, _, v in rows[:20]] + [(77, [0.0] * 8)]
    asked = spark.createDataFrame(queries, "query_id bigint, embedding array<float>")
    hits = search_vectors(asked, vectors, k, sent_numbers=sent).collect()
    ours = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in hits)
    expected = brute_force(queries, rows, k)
    assert [r[:3] for r in ours] == [r[:3] for r in expected]
    assert [r[3] for r in ours] == pytest.approx([r[3] for r in expected], abs=1e-6)


def test_no_queries(spark, vectors):
    none = spark.createDataFrame([], "query_id bigint, embedding array<float>")
    assert search_vectors(none, vectors).count() == 0


def test_queries_of_different_lengths(spark, vectors):
    mixed = spark.createDataFrame(
        [(1, [1.0]), (2, [1.0, 2.0])], "query_id bigint, embedding array<float>"
    )
    with pytest.raises(ValueError):
        search_vectors(mixed, vectors)
    short = spark.createDataFrame([(1, [1.0])], "query_id bigint, embedding array<float>")
    with pytest.raises(ValueError):
        search_vectors(short, vectors)


@pytest.mark.parametrize("tasks", [1, 2])
def test_the_layout_of_tasks_changes_nothing(spark, tasks):
    """Two scores that are equal at six places, whether or not they meet in one task."""
    rows = [(1, [0.1250005, (1 - 0.1250005**2) ** 0.5]), (2, [0.125001, (1 - 0.125001**2) ** 0.5])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    asked = spark.createDataFrame([(7, [1.0, 0.0])], "query_id bigint, embedding array<double>")
    hit = search_vectors(asked, vectors.repartition(tasks, "vec_id"), 1).first()
    assert hit["vec_id"] == 1 and hit["score"] == 0.125001


def test_centroids(spark):
    vectors = spark.createDataFrame(
        [(1, 0, [1.0, 2.0]), (2, 0, [3.0, 6.0]), (3, 1, [5.0, 5.0])], SCHEMA
    )
    rows = {r["query_id"]: r["embedding"] for r in centroids(vectors, "label").collect()}
    assert rows == {0: [2.0, 4.0], 1: [5.0, 5.0]}
