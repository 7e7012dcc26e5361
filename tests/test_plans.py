"""Physical plans: pruning, group limits, top-k, and Python only where it is said to be."""

import pytest

from docketry import catalog

DATA = "/root/testdata/sf0.001"
#: Queries whose operators run Python in Arrow batches.
PYTHON: set[str] = set()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(catalog.QUERIES[name](spark, DATA))
    assert ("Python" in text or "InPandas" in text or "InArrow" in text) == (name in PYTHON)
    assert "Cartesian" not in text and "BroadcastNestedLoop" not in text


def test_group_limit_and_top_k(spark):
    assert "WindowGroupLimit" in plan(catalog.best_row_tiebreak(spark, DATA))
    assert "WindowGroupLimit" in plan(catalog.limit_per_group(spark, DATA))
    assert "TakeOrderedAndProject" in plan(catalog.topk_groups(spark, DATA))


def test_columns_are_pruned_and_filters_pushed(spark):
    text = plan(catalog.month_timeline(spark, DATA))
    assert "ReadSchema: struct<o_orderdate:timestamp" in text and "o_totalprice" not in text
    assert "IsNotNull(o_orderdate)" in text.split("PushedFilters")[1].split("]")[0]
    assert "EqualTo(c_mktsegment,MACHINERY)" in plan(catalog.selected_rows(spark, DATA)).split("PushedFilters")[-1]


def test_one_shuffle_for_distinct_keys(spark):
    """A row a key first, then one row: one shuffle by key and one of a row a task."""
    assert plan(catalog.status_distinct(spark, DATA)).count("Exchange hashpartitioning") == 1
