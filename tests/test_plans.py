"""What the physical plans of some queries must not hold."""

import re

import pytest

from strataloom.plans import load_all

ROOT = "/root/testdata/sf0.001"


def plan(spark, name):
    df = load_all()[name](spark, ROOT)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["inventory_position", "warehouse_utilization"])
def test_stock_reads_neither_orders_nor_customers(spark, name):
    text = plan(spark, name)
    assert "l_suppkey" in text
    assert "o_orderkey" not in text and "c_custkey" not in text


@pytest.mark.parametrize("name", ["fulfilment", "supplier_scorecard", "open_orders_by_history"])
def test_purchases_read_no_customers(spark, name):
    assert "c_custkey" not in plan(spark, name)


def test_numbering_moves_rows_once(spark):
    from strataloom.operators.ranking import number_rows

    text = number_rows(spark.range(1000), ["id"], "n")._jdf.queryExecution().executedPlan().toString()
    moved = re.findall(r"Exchange hashpartitioning\(_part[^)]*\).*", text)
    # only the sums of the ranges, one row per range and task, go by range number
    assert all("ENSURE_REQUIREMENTS" in m for m in moved) and len(moved) <= 1


def test_distinct_counts_repeat_no_rows(spark):
    """Hosts and rules of an incident are counted without a row for each of both."""
    assert "Expand" not in plan(spark, "incident_correlation")
