"""Aggregate and ratio expressions with the NULL rules of the marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.contracts import MIN_COVERAGE

MONEY = "decimal(38,2)"


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL where the denominator is zero or either side is NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def money_sum(value: Column, where: Column | None = None) -> Column:
    """Exact sum of a money column; NULL when no row qualifies."""
    return F.sum(value if where is None else F.when(where, value)).cast(MONEY)


def mean(value: Column, where: Column | None = None) -> Column:
    """Average of the non-NULL values as double. Decimals are summed exactly first, so the result
    does not depend on the order in which partitions arrive."""
    kept = value if where is None else F.when(where, value)
    return ratio(F.sum(kept), F.count(kept))


def rate(flag: Column, where: Column | None = None) -> Column:
    """Share of true among the rows where the flag is known."""
    return mean(flag.cast("int"), where)


def weighted_mean(value: Column, weight: Column, where: Column | None = None) -> Column:
    """Sum of value x weight over the sum of weights; NULL unless the weights sum above zero."""
    kept = weight if where is None else F.when(where, weight)
    total = F.sum(kept)
    return F.when(total > 0, ratio(F.sum(value * kept), total))


def finite(c: Column) -> Column:
    """The number, or NULL for NULL, NaN and both infinities."""
    number = c.cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != F.lit(float("inf"))), c)


def coverage_flag(members: Column, minimum: int = MIN_COVERAGE) -> Column:
    return F.when(members >= minimum, "PUBLISHABLE").otherwise("SUPPRESSED")


def on_or_before(ts: Column, day: date) -> Column:
    """``date(ts) <= day``, written against the bare column so that it reaches the file scan."""
    return ts < F.date_add(F.lit(day), 1).cast("timestamp_ntz")


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month")
