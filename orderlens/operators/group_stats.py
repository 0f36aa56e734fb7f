"""Exact median and mode per group that stay exact and spread out when one group is huge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.operators.counted_join import join_counted
from orderlens.session import materialize

# The sketch's rank error is 1 / accuracy of a group. The bracket around the middle reaches ten
# times as far on each side, and is ranked in equal slices of its width.
ACCURACY = 10_000
MARGIN = 0.001
_SLICES = 256
_ENDLESS = float("inf")


def group_mode(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Most frequent non-NULL value of each column per key; ties take the smallest value.

    Rows are counted per key and value combination before they move, so a hot key costs one row per
    combination and task.
    """
    counted = rows.groupBy(key, *columns).agg(F.count("*").alias("n"))
    long = counted.select(
        key,
        "n",
        F.posexplode(F.array(*[F.col(c) for c in columns])).alias("which", "value"),
    ).filter(F.col("value").isNotNull())
    tallied = long.groupBy(key, "which", "value").agg(F.sum("n").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value").alias("value")))
    top = tallied.groupBy(key, "which").agg(best.alias("best"))
    return top.groupBy(key).agg(
        *[F.max(F.when(F.col("which") == i, F.col("best.value"))).alias(c) for i, c in enumerate(columns)]
    )


def group_median(
    rows: DataFrame,
    key: str,
    columns: Sequence[str],
    count: str = "rows",
    accuracy: int = ACCURACY,
    margin: float = MARGIN,
) -> DataFrame:
    """Exact interpolating median of each column per key, NULLs skipped, and the row count.

    Values stand in the total order of doubles: NaN is a class of its own above infinity. The sketch
    sees NaN as infinity, so ranks are right, and the NaN are counted apart; a middle beyond the other
    values is NaN.

    A mergeable sketch brackets the middle of every group; values above the bracket are dropped, values
    below it only counted, and the few inside are ranked slice by slice. The rows ranked are about 0.2 %
    of a group, in up to 256 tasks. The counts show whether the bracket holds the middle. Where it does
    not, a second bracket moves the end that was wrong to the group's least or greatest value, and keeps
    the other, so it cannot miss. The counted brackets are stored.
    """
    read = rows.select(
        F.col(key).alias("key"), *[F.col(c).cast("double").alias(f"v_{i}") for i, c in enumerate(columns)]
    )
    values = [F.nanvl(f"v_{i}", F.lit(_ENDLESS)) for i in range(len(columns))]
    middle = F.array(F.lit(0.5 - margin), F.lit(0.5 + margin))
    brackets = read.groupBy("key").agg(
        *[
            F.struct(
                F.count(f"v_{i}").alias("size"),
                F.count(F.when(~F.isnan(f"v_{i}"), F.col(f"v_{i}"))).alias("ordered"),
                F.element_at(sketch := F.percentile_approx(value, middle, F.lit(accuracy)), 1).alias("low"),
                F.element_at(sketch, 2).alias("high"),
                F.min(value).alias("least"),
                F.max(value).alias("most"),
            ).alias(f"b_{i}")
            for i, value in enumerate(values)
        ]
    )
    counted = materialize(_counted(read, brackets, values))
    middles = _middles(counted)
    missed = middles.where("lower is null or upper is null")
    if not missed.isEmpty():
        wider = materialize(_counted(read, _second_brackets(counted, missed, len(columns)), values))
        middles = middles.where("lower is not null and upper is not null").union(_middles(wider))
    medians = middles.groupBy("key").agg(
        *[F.max(F.when(F.col("which") == i, _halfway())).alias(f"m_{i}") for i in range(len(columns))]
    )
    sizes = rows.groupBy(F.col(key).alias("group")).agg(F.count("*").alias("size"))
    # A NULL key is a group too.
    return sizes.join(medians, F.col("group").eqNullSafe(F.col("key")), "left").select(
        F.col("group").alias(key), F.col("size").alias(count), *[F.col(f"m_{i}").alias(c) for i, c in enumerate(columns)]
    )


_GROUP = ("key", "which", "size", "ordered", "low", "high", "least", "most")


def _counted(read: DataFrame, brackets: DataFrame, values: Sequence[Column]) -> DataFrame:
    """Of each group how often each value inside its bracket stands, by slices of the bracket's width.
    Slice -1 is the count of everything below."""
    sides = [F.struct(value.alias("value"), f"b_{i}.*").alias(f"s_{i}") for i, value in enumerate(values)]
    # A left join cannot send the rows whole to every task, however small their files; rows without a bracket,
    # in a second round, have nothing below ``high``.
    groups = read.select("key").distinct()
    same = F.col("key").eqNullSafe(F.col("of"))
    together = join_counted(read, brackets.withColumnRenamed("key", "of"), same, "left", counted=groups)
    value, low, high = F.col("value"), F.col("low"), F.col("high")
    width = high - low
    slice_number = F.when((width > 0) & (width < _ENDLESS), F.floor((value - low) / width * _SLICES)).otherwise(0)
    return (
        together.select("key", F.posexplode(F.array(*sides)).alias("which", "side"))
        .select("key", "which", "side.*")
        .where(value <= high)
        .groupBy(
            *_GROUP,
            F.when(value < low, -1).otherwise(slice_number).alias("slice"),
            F.when(value >= low, value).alias("value"),
        )
        .agg(F.count("*").alias("n"))
    )


def _middles(counted: DataFrame) -> DataFrame:
    """The lower and the upper middle of each group; NULL where its bracket does not hold it."""
    slices = counted.groupBy("key", "which", "slice").agg(F.sum("n").alias("in_slice"))
    up_to = W.partitionBy("key", "which").orderBy("slice").rowsBetween(W.unboundedPreceding, W.currentRow)
    offsets = slices.select(
        F.col("key").alias("of"), "which", "slice", (F.sum("in_slice").over(up_to) - F.col("in_slice")).alias("before")
    )
    inside = W.partitionBy("key", "which", "slice").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = counted.join(offsets, ["which", "slice"]).where(F.col("key").eqNullSafe(F.col("of")))
    ranked = placed.withColumn("upto", F.col("before") + F.sum("n").over(inside))

    def at(rank: Column) -> Column:
        here = (F.col("slice") >= 0) & (F.col("upto") - F.col("n") < rank) & (rank <= F.col("upto"))
        found = F.min(F.when(here, F.col("value")))
        # NaN come after all that have an order.
        return F.when(F.bool_or(rank > F.col("ordered")), F.lit(float("nan"))).otherwise(found)

    return ranked.groupBy("key", "which").agg(
        at(F.expr("(size + 1) div 2")).alias("lower"), at(F.expr("size div 2 + 1")).alias("upper")
    )


def _second_brackets(counted: DataFrame, missed: DataFrame, columns: int) -> DataFrame:
    """For groups whose middle was missed: from the least value where it lies below the bracket, to the
    greatest where it lies above. NULL for the columns that were found."""
    below = F.sum(F.when(F.col("slice") < 0, F.col("n")).otherwise(0))
    ends = counted.groupBy(*_GROUP).agg(below.alias("below"), F.sum("n").alias("upto"))
    wanted = missed.select(F.col("key").alias("of"), "which")
    ends = ends.join(wanted, "which").where(F.col("key").eqNullSafe(F.col("of")))
    lower, upper = F.expr("(size + 1) div 2"), F.expr("size div 2 + 1")
    moved = F.struct(
        "size",
        "ordered",
        F.when(lower <= F.col("below"), F.col("least")).otherwise(F.col("low")).alias("low"),
        F.when(upper > F.col("upto"), F.col("most")).otherwise(F.col("high")).alias("high"),
        "least",
        "most",
    )
    return ends.groupBy("key").agg(
        *[F.max(F.when(F.col("which") == i, moved)).alias(f"b_{i}") for i in range(columns)]
    )


def _halfway() -> Column:
    lower, upper = F.col("lower"), F.col("upper")
    endless = (F.abs(lower) == _ENDLESS) | (F.abs(upper) == _ENDLESS)
    return F.when(lower == upper, lower).when(endless, lower + upper).otherwise(lower + (upper - lower) * 0.5)
