"""A join that sends a table whole to every task only if the table has few rows.

Spark judges a table by the bytes of its files, and packed files of keys hold a hundred times their bytes in
rows. A broadcast is put together on the driver, so a table that looks small would fill its memory; and one
that is planned so stays so, because the adaptive planner takes no plan with more shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

BROADCAST_ROWS = 200_000
"""Rows of a table that a join may send to every task; some 30 MB on the driver."""


def join_counted(
    left: DataFrame, right: DataFrame, on: str | Column, how: str = "inner", counted: DataFrame | None = None
) -> DataFrame:
    """``left.join(right, on, how)`` by sorting and merging where ``right`` has many rows; a table of few rows is
    left to Spark. ``counted`` is a frame with at least as many rows that is cheaper to count than ``right``."""
    many = (right if counted is None else counted).count() > BROADCAST_ROWS
    return left.join(right.hint("merge") if many else right, on, how)
