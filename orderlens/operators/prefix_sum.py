"""Exclusive prefix sum over an ordered column without sending all rows to one task.

``sum(x) over (order by v desc)`` plans one partition. Here the rows are grouped by value range,
``floor(v / width)``, the range totals are prefix-summed first (again by this operator when more
widths are given), and each range is then summed on its own with its offset added. The range is a
function of the value, so nothing is sampled, equal values stay together, and a recomputed task
gives the same answer. With one row per distinct value a range holds at most ``width / unit`` rows.
The default widths follow the scale of the order column: a million units, then twice a thousand
ranges, so no task sums more than a million rows while the values spread over less than 10^18 units,
whatever the number of input rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE_UNITS = 1_000_000
CASCADE = (1_000, 1_000)


def default_widths(kind: T.DataType) -> tuple[Decimal | int, ...]:
    """A first width of a million units of the type's scale, then widths in ranges."""
    scale = kind.scale if isinstance(kind, T.DecimalType) else 0
    width = Decimal(RANGE_UNITS).scaleb(-scale)
    return (int(width) if width == int(width) else width, *CASCADE)


def prefix_sum(
    rows: DataFrame,
    order_by: str,
    amount: str,
    partition_by: Sequence[str] = (),
    widths: Sequence[Decimal | int] | None = None,
    before: str = "sum_before",
    total: str = "sum_total",
) -> DataFrame:
    """Add ``before`` (sum of ``amount`` over all greater ``order_by`` values) and ``total``.

    ``rows`` holds one row per ``order_by`` value and partition, so the sums are those of a running
    window in descending order, less the current row. ``order_by`` must be an integer or a decimal;
    rows where it is NULL have no place in the order and are left out.
    """
    kind = rows.schema[order_by].dataType
    if not isinstance(kind, (T.DecimalType, T.IntegralType)):
        raise TypeError(f"{order_by} must be an integer or a decimal, not {kind.simpleString()}")
    widths = default_widths(kind) if widths is None else widths
    keys = list(partition_by)
    rows = rows.filter(F.col(order_by).isNotNull())
    money = rows.schema[amount].dataType
    out_type = f"decimal(38,{money.scale})" if isinstance(money, T.DecimalType) else "bigint"

    if not widths:
        whole = W.partitionBy(*keys)
        running = whole.orderBy(F.desc(order_by)).rowsBetween(W.unboundedPreceding, W.currentRow)
        return rows.withColumns(
            {
                before: (F.sum(amount).over(running) - F.col(amount)).cast(out_type),
                total: F.sum(amount).over(whole).cast(out_type),
            }
        )

    quotient = F.expr(f"`{order_by}` div {widths[0]}")
    if isinstance(kind, T.DecimalType):
        quotient = F.floor(F.col(order_by) / F.lit(widths[0]))
    # Never NULL, and declared so: both sides of the join below then share one exchange of the rows.
    level = len(widths)
    range_id, range_sum, offset = f"__range_{level}", f"__sum_{level}", f"__offset_{level}"
    ranged = rows.withColumn(range_id, F.coalesce(quotient, F.lit(0)))
    totals = ranged.groupBy(*keys, range_id).agg(F.sum(amount).cast(out_type).alias(range_sum))
    offsets = prefix_sum(totals, range_id, range_sum, keys, widths[1:], offset, total)
    inside = (
        W.partitionBy(*keys, range_id)
        .orderBy(F.desc(order_by))
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    # NULL partition keys are partitions too.
    placed = offsets.select(*[F.col(k).alias(f"__{k}_{level}") for k in keys], F.col(range_id).alias("__placed"), offset, total)
    same = [F.col(k).eqNullSafe(F.col(f"__{k}_{level}")) for k in keys]
    return (
        ranged.join(placed, reduce(Column.__and__, same, F.col(range_id) == F.col("__placed")))
        .withColumn(before, (F.col(offset) + F.sum(amount).over(inside) - F.col(amount)).cast(out_type))
        .select(*rows.columns, before, total)
    )
