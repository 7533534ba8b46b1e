"""Ingest of files with columns nobody declared, exactly once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.contract.tables import private_namespace
from ledgerloom.session import open_namespace
from ledgerloom.sinks import BATCH, write_batch
from ledgerloom.streaming import evolving, ingest_evolving


@pytest.fixture
def target(spark):
    with private_namespace(spark) as private:
        yield open_namespace(spark, **private).table("landed")


def drop(spark, folder, name, rows, columns, fmt="parquet"):
    getattr(spark.createDataFrame(rows, columns).coalesce(1).write, fmt)(f"{folder}/{name}")


def run(spark, tmp_path, target, fmt="parquet"):
    return ingest_evolving(spark, f"{tmp_path}/land/*", target, f"{tmp_path}/progress", fmt)


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_a_further_column_is_rescued_and_then_a_column(spark, tmp_path, target, fmt):
    land = f"{tmp_path}/land"
    drop(spark, land, "a", [(1, "x")], "id long, what string", fmt)
    assert run(spark, tmp_path, target, fmt).drop("source_file").collect() == [(1, "x")]
    drop(spark, land, "b", [(2, "y", 2.5, "it's")], "id long, what string, size double, `odd name` string", fmt)
    rows = run(spark, tmp_path, target, fmt).drop("source_file")
    assert "size" not in spark.table(target).columns
    assert spark.table(target).where(f"{evolving.RESCUED} IS NOT NULL").count() == 1
    as_dicts = sorted((r.asDict() for r in rows.collect()), key=lambda r: r["id"])
    assert as_dicts[1] == {"id": 2, "what": "y", "size": 2.5, "odd name": "it's"}
    drop(spark, land, "c", [(3, 0.5)], "id long, size double", fmt)
    rows = run(spark, tmp_path, target, fmt)
    assert "size" in spark.table(target).columns
    assert sorted((r["id"], r["what"], r["size"], r["odd name"]) for r in rows.collect()) == [
        (1, "x", None, None), (2, "y", 2.5, "it's"), (3, None, 0.5, None),
    ]
    assert rows.where("source_file IS NULL").isEmpty() and run(spark, tmp_path, target, fmt).count() == 3


def test_a_run_cut_off_before_its_commit_stores_each_row_once(spark, tmp_path, target, monkeypatch):
    drop(spark, f"{tmp_path}/land", "a", [(i,) for i in range(5)], "id long")
    real = evolving.write_batch

    def killed(*given):
        real(*given)
        raise RuntimeError("killed after writing")

    monkeypatch.setattr(evolving, "write_batch", killed)
    with pytest.raises(Exception, match="killed after writing"):
        run(spark, tmp_path, target)
    assert spark.table(target).count() == 5
    monkeypatch.setattr(evolving, "write_batch", real)
    assert run(spark, tmp_path, target).count() == 5
    drop(spark, f"{tmp_path}/land", "b", [(9,)], "id long")
    assert sorted(r["id"] for r in run(spark, tmp_path, target).collect()) == [0, 1, 2, 3, 4, 9]


def test_batches_of_several_streams_do_not_touch_each_other(spark, target):
    rows = spark.range(4).withColumn("from", F.lit("a"))
    write_batch(rows, target, "a", 0)
    write_batch(rows, target, "it's", 0)
    write_batch(rows.where("id < 2"), target, "a", 1)
    write_batch(rows.where("id < 1").withColumn("more", F.lit(1)), target, "a", 0)
    found = spark.table(target).groupBy("_stream", BATCH).count().collect()
    assert sorted(map(tuple, found)) == [("a", 0, 1), ("a", 1, 2), ("it's", 0, 4)]
    write_batch(rows.limit(0), target, "a", 1)
    assert spark.table(target).where(f"_stream = 'a' AND {BATCH} = 1").isEmpty()


def test_values_that_do_not_fit_stop_the_run_and_nothing_is_stored(spark, tmp_path, target):
    drop(spark, f"{tmp_path}/land", "a", [(1,)], "id long")
    run(spark, tmp_path, target)
    drop(spark, f"{tmp_path}/land", "b", [("one",)], "id string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        run(spark, tmp_path, target)
    assert spark.table(target).count() == 1


def test_nothing_has_landed(spark, tmp_path, target):
    (tmp_path / "land").mkdir()
    assert run(spark, tmp_path, target).columns == ["source_file"]
    drop(spark, f"{tmp_path}/land", "a", [], "id long")
    assert run(spark, tmp_path, target).count() == 0
