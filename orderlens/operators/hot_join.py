"""A join in which rows of very frequent keys are split among tasks, whatever stands below it.

The adaptive skew join splits only a join whose inputs were shuffled for it and nothing else. Here the
frequent keys of the larger side are found first, by a mergeable summary of that one column, and only
their rows are salted: dealt over as many parts as their share of all rows asks for, while the other
side's row is repeated once per part. All other rows join as ever.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The summary tracks this many keys; its error is below 1.5 / 4096 of all rows.
_TRACKED = 4_096
# Pieces per share: a few small pieces that meet in one task are no great share either.
_PIECES = 4
PART = "__part"


def hot_keys(rows: DataFrame, key: str, parts: int) -> dict:
    """Keys that hold more than one of ``parts`` equal shares of the rows, and into how many pieces to
    deal each, a quarter of a share or less. Fewer than ``parts`` keys can, so the answer is small however many rows there are.

    Every task summarizes its rows in bounded space and the summaries are merged; no row is moved.
    """
    known = rows.where(F.col(key).isNotNull())
    summary = known.agg(
        F.count("*").alias("rows"), F.expr(f"approx_top_k(`{key}`, {min(parts, _TRACKED // 4)}, {_TRACKED})").alias("top")
    ).first()
    share = summary["rows"] / parts
    return {top["item"]: math.ceil(_PIECES * top["count"] / share) for top in summary["top"] or [] if top["count"] > share}


def _parts_of(key: Column, hot: dict) -> Column:
    """Into how many parts a key's rows go: 1 for nearly all keys."""
    parts = F.lit(1)
    for n in sorted(set(hot.values())):
        parts = F.when(key.isin([k for k, of in hot.items() if of == n]), n).otherwise(parts)
    return parts


def join_hot(left: DataFrame, rows: DataFrame, key: str, parts: int | None = None, hot: dict | None = None) -> DataFrame:
    """Inner join of ``left`` with ``rows`` on a column of both, where a few keys may hold most of ``rows``.

    ``parts`` is into how many shares the rows should come apart, by default as many as a shuffle has
    partitions; ``hot`` gives the frequent keys where they are known. Without a frequent key this is the
    plain join, over whatever partitioning the inputs already have. ``left`` rows of a frequent key are
    repeated, so they should be few; the result is the plain join's in any case.

    Rows are dealt by a hash of all their columns, so that a task that runs again deals them alike; rows
    of a frequent key that are equal in every column stay together.
    """
    if hot is None:
        parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hot = hot_keys(rows, key, parts)
    if not hot:
        return left.join(rows, key)
    n = _parts_of(F.col(key), hot)
    dealt = rows.withColumn(PART, F.pmod(F.xxhash64(*rows.columns), n.cast("bigint")).cast("int"))
    repeated = left.withColumn(PART, F.explode(F.sequence(F.lit(0), n - 1)))
    return repeated.join(dealt, [key, PART]).drop(PART)
