"""Checks of keys in one pass: rows beyond the distinct keys, and rows whose key another table lacks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Keyed:
    """Rows that stand on one side of a kind of key: those that define it, or those that refer to it."""

    kind: str
    rows: DataFrame
    columns: Sequence[str]
    refers: bool = False


def _known(columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def _is_number(part: int, sides: Sequence[Keyed]) -> bool:
    return all(isinstance(side.rows.schema[side.columns[part]].dataType, T.IntegralType) for side in sides)


def _part(what: str, i: int) -> str:
    return f"{what}_{i}"


_TYPES = {"number": "bigint", "text": "string"}


def _tagged(side: Keyed, kind: int, shared: Sequence[str], numbers: Sequence[bool]) -> DataFrame:
    """Key parts in columns that all kinds share, whole numbers as such and all else as text, so that keys
    are equal however each side types them. A key with a NULL part is none, and has no parts."""
    known = _known(side.columns)
    parts = {
        _part("number" if numbers[i] else "text", i): F.when(known, F.col(c)) for i, c in enumerate(side.columns)
    }
    return side.rows.select(
        F.lit(kind).alias("kind"),
        *[parts.get(name, F.lit(None)).cast(_TYPES[name.split("_")[0]]).alias(name) for name in shared],
        F.lit(int(not side.refers)).cast("bigint").alias("defined"),
        F.lit(int(side.refers)).cast("bigint").alias("referred"),
    )


def key_totals(sides: Sequence[Keyed]) -> DataFrame:
    """Per kind: ``surplus`` rows, that is defining rows beyond the distinct keys, and ``orphans``, that is
    referring rows whose key no row defines. A key with a NULL part is none: it is surplus, and an orphan.

    All kinds and both sides of each are one union and one aggregate: a key is counted where it stands
    before it moves, so what is shuffled, once, is one row per key, kind and task, and a key that holds
    a third of all rows costs no more than any other. A kind without rows has no row here.
    """
    kinds = list(dict.fromkeys(side.kind for side in sides))
    numbers, used = {}, set()
    for kind in kinds:
        alike = [side for side in sides if side.kind == kind]
        numbers[kind] = [_is_number(i, alike) for i in range(len(alike[0].columns))]
        used |= {_part("number" if number else "text", i) for i, number in enumerate(numbers[kind])}
    # Every key carries these columns through the shuffle: only those that some kind uses, and kinds as numbers.
    shared = sorted(used)
    tagged = [_tagged(side, kinds.index(side.kind), shared, numbers[side.kind]) for side in sides]
    per_key = reduce(DataFrame.unionAll, tagged).groupBy("kind", *shared).agg(
        F.sum("defined").alias("defined"), F.sum("referred").alias("referred")
    )
    known = reduce(Column.__or__, [F.col(name).isNotNull() for name in shared])
    beyond = F.when(known, F.greatest(F.col("defined") - 1, F.lit(0))).otherwise(F.col("defined"))
    lost = F.when(known & (F.col("defined") > 0), 0).otherwise(F.col("referred"))
    named = F.element_at(F.array(*[F.lit(kind) for kind in kinds]), F.col("kind") + 1)
    totals = per_key.groupBy("kind").agg(F.sum(beyond).alias("surplus"), F.sum(lost).alias("orphans"))
    return totals.withColumn("kind", named)


def nested_surplus(rows: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row: for the first column, the first two, and so on, the rows beyond the distinct keys.

    The keys are nested, so the finest is counted first and rolled up a column at a time. Several
    distinct counts asked for at once would copy every row for each; here no row is copied, and each
    step moves one row per key of the step before.
    """
    if len(names) != len(columns):
        raise ValueError("one name for each length of the key")
    counted = rows.groupBy(*columns).agg(F.count("*").alias("rows"))
    found: list[str] = []
    for length in range(len(columns), 0, -1):
        distinct = f"distinct_{length}"
        kept = [F.sum(c).alias(c) for c in ("rows", *found)]
        coarser = counted.groupBy(*columns[: length - 1]) if length > 1 else counted
        counted = coarser.agg(*kept, F.count_if(_known(columns[:length])).alias(distinct))
        found.append(distinct)
    total = F.coalesce("rows", F.lit(0))
    return counted.select(
        *[(total - F.coalesce(f"distinct_{i}", F.lit(0))).alias(name) for i, name in enumerate(names, 1)]
    )
