"""Intervals: their draws, their coverage, and that layout does not matter."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.bootstrap import difference_intervals, evaluate_intervals, weight


def test_weights_are_poisson(spark):
    digests = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("d"))
    found = Counter(r["w"] for r in digests.select(weight(F.col("d"), 2).alias("w")).collect())
    for k in range(5):
        expected = math.exp(-1) / math.factorial(k)
        assert found[k] / 20_000 == pytest.approx(expected, abs=0.015)


def by_hand(cases, resamples):
    """Hit rates of all resamples, for (case, hit)."""
    rates = []
    for r in range(resamples):
        n = hits = 0
        for case, hit in cases:
            digits = hashlib.md5(f"1:{case}:{r // 4}".encode()).hexdigest()[r % 4 * 8 :][:8]
            u, w, below = int(digits, 16) / 16**8, 0, 0.0
            while u >= (below := below + math.exp(-1) / math.factorial(w)) and w < 11:
                w += 1
            n, hits = n + w, hits + w * hit
        rates.append(hits / n)
    return sorted(rates)


def runs(spark, n, right, seed=7):
    rng = random.Random(seed)
    truth = [(i, rng.randint(0, 1)) for i in range(n)]
    said = [(i, t if rng.random() < right else 1 - t) for i, t in truth]
    return (
        spark.createDataFrame(truth, "case_id int, truth int"),
        spark.createDataFrame(said, "case_id int, said int"),
        [(i, int(s == t)) for (i, t), (_, s) in zip(truth, said, strict=True)],
    )


def test_intervals_equal_those_by_hand(spark):
    truth, said, hits = runs(spark, 40, 0.8)
    found = evaluate_intervals(said.repartition(3), truth, "said", "truth", resamples=41)
    row = found.where("measure = 'hit_rate'").first()
    rates = by_hand(hits, 41)
    assert row["value"] == pytest.approx(sum(h for _, h in hits) / 40)
    assert (row["low"], row["high"]) == pytest.approx((rates[1], rates[39]), abs=1e-6)
    again = evaluate_intervals(said.coalesce(1), truth.repartition(5), "said", "truth", resamples=41)
    assert sorted(found.collect()) == sorted(again.collect())


def test_intervals_cover_the_truth(spark):
    """Sixty samples of 150 cases each as groups: nearly all intervals hold the true rate."""
    truth, said, _ = runs(spark, 9000, 0.8)
    grouped = truth.withColumn("sample", F.col("case_id") % 60)
    found = evaluate_intervals(said, grouped, "said", "truth", ["sample"])
    rates = found.where("measure = 'hit_rate'").collect()
    held = sum(r["low"] <= 0.8 <= r["high"] for r in rates)
    assert len(rates) == 60 and 52 <= held


def test_a_difference_is_real_only_if_there_is_one(spark):
    truth, better, _ = runs(spark, 2000, 0.9)
    _, worse, _ = runs(spark, 2000, 0.8)
    real = {r["measure"]: r for r in difference_intervals(worse, better, truth, "said", "truth").collect()}
    assert all(r["is_real"] and r["low"] > 0 for r in real.values()) and len(real) == 4
    same = difference_intervals(better, better, truth, "said", "truth").collect()
    assert all((r["value"], r["low"], r["high"], r["is_real"]) == (0, 0, 0, False) for r in same)


def test_no_cases_and_groups_without_a_name(spark):
    truth, said, _ = runs(spark, 4, 1.0)
    assert evaluate_intervals(said, truth.limit(0), "said", "truth").count() == 0
    nameless = truth.withColumn("g", F.lit(None).cast("string"))
    assert evaluate_intervals(said, nameless, "said", "truth", ["g"]).count() == 4
