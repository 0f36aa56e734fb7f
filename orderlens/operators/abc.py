"""ABC classes that respect ties: equal values always share a class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.contracts import VALUE_CUTS
from orderlens.functions.measures import MONEY, ratio
from orderlens.operators.prefix_sum import prefix_sum


def value_buckets(rows: DataFrame, value: str) -> DataFrame:
    """One row per distinct value: its tied members and their summed value."""
    return rows.groupBy(value).agg(
        F.count("*").alias("customers_in_tie"),
        F.sum(value).cast(MONEY).alias("bucket_gmv_brl"),
    )


def bucket_cumulative(buckets: DataFrame, value: str, widths: Sequence[int] | None = None) -> DataFrame:
    """Share of the total held by all strictly greater values; NULL where the total is zero."""
    summed = prefix_sum(buckets, value, "bucket_gmv_brl", widths=widths)
    return summed.select(
        value, ratio(F.col("sum_before"), F.col("sum_total")).alias("cumulative_share_before")
    )


def class_floors(
    rows: DataFrame,
    value: str,
    cuts: Sequence[float] = VALUE_CUTS,
    widths: Sequence[int] | None = None,
) -> DataFrame:
    """One row: for each cut, the smallest positive value whose share before it is below the cut.

    Among positive values the share before never falls as the value falls, so a class is exactly
    the values at or above its floor and no member has to be joined to its bucket.
    """
    shares = bucket_cumulative(value_buckets(rows, value), value, widths)
    in_class = F.col(value) > 0
    return shares.agg(
        *[
            F.min(F.when(in_class & (F.col("cumulative_share_before") < cut), F.col(value))).alias(f"floor_{i}")
            for i, cut in enumerate(cuts)
        ]
    )


def abc_class(
    rows: DataFrame,
    value: str,
    cuts: Sequence[float] = VALUE_CUTS,
    labels: Sequence[str] = ("A_HIGH_VALUE", "B_MEDIUM_VALUE", "C_LOW_VALUE"),
    no_value: str = "NO_VALUE",
    widths: Sequence[int] | None = None,
) -> Column:
    """Class of each row of ``rows``, as an expression over its value column.

    The floors are a scalar subquery over ``rows``; pass a materialized frame, or the work behind
    it is done twice. A row without a value has no class.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("one label per cut and one for the rest")
    floors = class_floors(rows, value, cuts, widths).select(F.struct("*")).scalar()
    amount = F.col(value)
    result = F.when(amount.isNull(), F.lit(None)).when(amount <= 0, no_value)
    for i in range(len(cuts)):
        result = result.when(amount >= floors.getField(f"floor_{i}"), labels[i])
    return result.otherwise(labels[-1])
