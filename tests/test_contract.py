"""Every registered query against its SQL, on the smallest test data."""

from __future__ import annotations

import os

import oracle
import pytest

import __spark_entry__ as contract
from ledgerloom.contract.oracle import ORACLE
from ledgerloom.contract.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")

@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, con, name):
    ours = contract.queries()[name](spark, SF_DIR)
    assert oracle.difference(ours, con, contract.oracle_sql()[name]) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "order_month", "market_segment", "n_orders", "total_sales", "avg_order_value",
    ]
    assert df.count() > 0
    gold_orders = sum(r["n_orders"] for r in df.collect())
    assert gold_orders == contract.queries()["orders_silver"](spark, SF_DIR).count()


def test_queries_leave_the_session_where_it_was(spark):
    before = spark.catalog.currentCatalog(), spark.catalog.currentDatabase()
    contract.queries()["namespace_setup"](spark, SF_DIR)
    assert (spark.catalog.currentCatalog(), spark.catalog.currentDatabase()) == before
