"""Registered queries against their SQL, at the smallest scale, and the shape of their plans."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
import check
from furlong.registry import load

QUERIES = {name: run for name, run in entry_point.queries().items() if name in load().queries}
SQL = entry_point.oracle_sql()

# Queries that store data while they are built.
STORES = ("s1_", "s2_", "s3_", "s4_", "s5_", "s10_", "s11_", "s12_", "s14_", "s16_", "s18_", "s19_", "t4_", "u2_", "u3_", "u4_", "u5_", "u_catalogue", "w4_latest_book_stream", "bronze_run", "catalogue_bronze", "book_bronze")

# One of each family; check.py runs all of them.
SAMPLE = [
    "orders_mart", "customers_mart", "order_items_mart", "race_runners_gold", "race_history", "catalogue_bronze", "book_bronze",
    "request_plan", "s10_insert_or_ignore", "u3_stream_distinct", "w1_customer_order_number_split", "c3_relationships",
]


@pytest.fixture(scope="module")
def con():
    return check.connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", SAMPLE)
def test_same_rows_as_sql(spark, con, sf_dir, name):
    ok, note = check.compare(spark, con, sf_dir, name, QUERIES[name], SQL[name])
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


def test_entry(spark):
    assert entry_point.entry(spark).limit(1).count() == 1


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_customers_read_orders_only(spark, sf_dir):
    text = plan(spark, sf_dir, "customers_mart")
    assert "lineitem" not in text and "Window" not in text


@pytest.mark.parametrize("name", ["race_history", "w3_first_writer", "w4_latest_book", "t1_first_to_start"])
def test_group_limit_below_the_shuffle(spark, sf_dir, name):
    assert "WindowGroupLimit" in plan(spark, sf_dir, name)


@pytest.mark.parametrize("name", ["p9_flatten_market", "s9_forms", "u1_flat_runners", "request_plan"])
def test_no_shuffle(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "hashpartitioning" not in text and "rangepartitioning" not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairs_and_no_python(spark, sf_dir, name):
    if name.startswith(STORES):
        pytest.skip("stores data while it is built")
    text = plan(spark, sf_dir, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text
