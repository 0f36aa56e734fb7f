"""Physical plans: what reaches the files, what moves, and what never meets in one place."""

from __future__ import annotations

import os

import pytest

from registry.queries import QUERIES, Canonical

SAMPLE = os.environ.get("ORDERLENS_SAMPLE", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SAMPLE), reason="needs the sample tables")


def _plan(spark, name: str) -> str:
    return QUERIES[name](spark, SAMPLE)._jdf.queryExecution().executedPlan().toString()


def _scans(plan: str) -> list[str]:
    return [line for line in plan.split("\n") if "FileScan" in line]


@pytest.mark.parametrize("step", ["executive_monthly", "delivered_lines", "delivery_experience"])
def test_the_cut_and_only_the_used_columns_reach_the_files(spark, step):
    """The delivered lines are the stored step that the category, seller and customer marts read."""
    scans = _scans(Canonical(spark, SAMPLE)[step]._jdf.queryExecution().executedPlan().toString())
    orders = [s for s in scans if "o_orderdate" in s]
    assert orders and all("LessThan(o_orderdate,1998-01-01T00:00)" in s for s in orders)
    assert all("o_totalprice" not in s and "l_comment" not in s and "l_tax" not in s for s in scans)


def test_marts_skip_the_facts_they_do_not_use(spark):
    """The full order summary is composed, and the joins no column comes from are gone."""
    plan = _plan(spark, "delivery_experience")
    assert "l_returnflag" not in plan and "l_extendedprice" not in plan
    plan = _plan(spark, "executive_monthly")
    assert "l_returnflag" not in plan and "l_suppkey" not in plan and "l_partkey" not in plan
