"""Gold from batches against Gold from all orders."""

from __future__ import annotations

import random

import pytest
from test_medallion import CUSTOMERS, orders

from ledgerloom.plans import rolling as module
from ledgerloom.plans.medallion import to_gold, to_silver
from ledgerloom.plans.rolling import RollingGold
from ledgerloom.session import open_namespace


@pytest.fixture
def ns(spark, tmp_path):
    yield open_namespace(spark, prefix=f"ns_{tmp_path.name}_".lower(), location=str(tmp_path))
    spark.sql("USE spark_catalog.default")


@pytest.fixture
def sides(spark):
    customers = [(i, f"c{i}", i % 3, ["AUTO", "FOOD", None][i % 3]) for i in range(6)] + [(6, "x", 99, "AUTO")]
    nations = spark.createDataFrame([(i, f"n{i}") for i in range(3)], "n_nationkey int, n_name string")
    return spark.createDataFrame(customers, CUSTOMERS), nations


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def made(rng, key):
    day = f"{rng.choice([1991, 1993, 1994, 1998])}-{rng.randint(1, 9):02}-11"
    price = rng.choice([None, 0.005, 10.5, rng.random() * 1000])
    return (key, rng.choice([0, 1, 2, 3, 4, 5, 6, None]), price, rng.choice([day, day, day, None]))


def test_batches_equal_a_rebuild(spark, ns, sides):
    rng = random.Random(3)
    gold, now, nameless = RollingGold(spark, ns), {}, []
    for number in range(1, 6):
        batch = [made(rng, rng.randint(1, 60)) for _ in range(40)]
        batch = list({r[0]: r for r in batch}.values()) + [made(rng, None)] * 2
        for row in batch:
            if row[0] is None:
                nameless.append(row)
            else:
                now[row[0]] = row
        for _ in range(1 + number % 2):
            gold.apply(number, orders(spark, *batch), *sides)
        whole = to_gold(to_silver(orders(spark, *now.values(), *nameless), *sides))
        assert rows_of(gold.gold()) == rows_of(whole)
    assert gold.gold().dtypes == whole.dtypes
    stored = [r["order_id"] for r in spark.table(gold.changes).collect()]
    assert len(stored) < 5 * 44  # every batch stores its own orders only


def test_a_run_that_ends_between_its_writes_is_made_up_for(spark, ns, sides, monkeypatch):
    gold = RollingGold(spark, ns)
    first, second = [(1, 1, 5.0, "1994-01-01"), (2, 0, 1.0, "1994-01-02")], [(1, 1, 7.0, "1994-02-01")]
    gold.apply(1, orders(spark, *first), *sides)
    whole, write = to_gold(to_silver(orders(spark, *second, first[1]), *sides)), module.write_batch

    def dies(df, table, *rest):
        if table == gold.partials:
            raise OSError("lost")
        write(df, table, *rest)

    monkeypatch.setattr(module, "write_batch", dies)
    with pytest.raises(OSError):
        gold.apply(2, orders(spark, *second), *sides)
    monkeypatch.undo()
    gold.apply(2, orders(spark, *second), *sides)
    assert rows_of(gold.gold()) == rows_of(whole)


def test_one_row_of_an_order_counts_and_batches_come_in_order(spark, ns, sides):
    gold = RollingGold(spark, ns)
    twice = orders(spark, (1, 1, 5.0, "1994-01-01"), (1, 1, 9.0, "1993-01-01")).withColumn("age", -module.F.col("o_totalprice"))
    gold.apply(4, twice, *sides, newest="age")
    assert [r["total_sales"] for r in gold.gold().collect()] == [5]
    with pytest.raises(ValueError, match="after batch 4"):
        gold.apply(3, twice, *sides)
    gold.apply(5, twice.limit(0), *sides)
    gold.apply(6, orders(spark, (1, 1, 5.0, None)), *sides)
    assert gold.gold().collect() == []
