"""Consecutive numbers for rows in an order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.session import materialize

_WITHIN = 33


def numbered(frame: DataFrame, *order: Column | str, name: str = "number") -> DataFrame:
    """The rows with their place in the order, from 0; stored, so that a place never changes.

    The rows are sorted by ranges and written; a written row knows its partition and its place there.
    What meets in one task, and is broadcast, is one count per partition. ``order`` should tell all
    rows apart: a range is split only between different values.
    """
    at, part, rows, before = (f"__{name}_{what}" for what in ("at", "part", "rows", "before"))
    sorted_rows = frame.orderBy(*order).withColumn(at, F.monotonically_increasing_id())
    stored = materialize(sorted_rows).withColumn(part, F.shiftright(at, _WITHIN))
    counts = stored.groupBy(part).agg(F.count("*").alias(rows))
    up_to = W.orderBy(part).rowsBetween(W.unboundedPreceding, W.currentRow)
    offsets = counts.select(part, (F.sum(rows).over(up_to) - F.col(rows)).alias(before))
    place = F.col(before) + F.col(at).bitwiseAND((1 << _WITHIN) - 1)
    return stored.join(F.broadcast(offsets), part).select(*frame.columns, place.alias(name))
