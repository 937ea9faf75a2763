"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from ledgermill.plans import catalogue
from tests.conftest import SF

NAMES = list(catalogue.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    state, note = compare(spark, con, name, SF)
    assert state == "OK", note or state


def test_register_is_consistent():
    assert set(catalogue.oracle_sql()) == set(NAMES)
    assert set(NAMES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


BATCH = [n for n in NAMES if not n.startswith(("stream_", "snapshot", "run_log_w", "queue_reset",
                                               "append_counts", "archive_w", "tax_report_m"))]


@pytest.mark.parametrize("name", BATCH)
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"):
        assert node not in plan


def plan_of(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_facts_are_grouped_before_dimensions_are_joined(spark):
    for name in ("fy_cashflow", "savings_rate", "spending_by_category", "monthly_spending"):
        plan = plan_of(spark, name)
        fact = plan.index("orders.parquet")
        # The plan prints from the root down: the partial aggregate sits right above the scan.
        assert "partial_sum" in plan[:fact].rsplit("Join", 1)[-1]


def test_scan_reads_only_the_columns_it_needs(spark):
    plan = plan_of(spark, "prim_between")
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp" in plan
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "text:" not in plan_of(spark, "home_cards")
