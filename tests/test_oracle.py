"""Every registered query next to its SQL on the smallest sample."""

from __future__ import annotations

import os
import re

import pytest

from registry.compare import connect, difference
from registry.oracle import ORACLE
from registry.queries import QUERIES

SAMPLE = os.environ.get("ORDERLENS_SAMPLE", "/root/testdata/sf0.001")

# On the smallest sample these may have nothing to show.
MAY_BE_EMPTY = {
    "invalid_chronology",
    "unmapped_categories",
    "orphan_reviews_without_order",
    "public_customer_cross_segment",
    "public_seller_performance",
    "published_roundtrip",
    "public_delivery_experience",
    "delivery_summary",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SAMPLE), reason="needs the sample tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SAMPLE)


def test_every_query_has_sql_unless_sql_cannot_say_it():
    assert set(QUERIES) - set(ORACLE) == {"landing_manifest", "snapshot_manifest"}
    assert set(QUERIES) >= MAY_BE_EMPTY
    assert set(ORACLE) <= set(QUERIES)


def _check_plan(frame, name: str) -> None:
    """No cross join, no Python but the digests of files, and no single task over rows."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert name.endswith(("_manifest", "_digests")) or not re.search(r"Python|Pandas|MapInArrow", plan)
    for single in plan.split("Exchange SinglePartition")[1:]:
        # One partition receives partial totals of an aggregate, or the totals of value ranges.
        below = single.split("\n")[1]
        assert "partial_" in below or "merge_" in below or "__range_" in below, below


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    frame = QUERIES[name](spark, SAMPLE)
    _check_plan(frame, name)
    problem, rows = difference(connection, name, frame)
    assert not problem
    assert rows > 0 or name in MAY_BE_EMPTY
