"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_BATCH = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str = "text") -> list:
    """128 bits of a text's content as two longs, ``k1`` and ``k2``; null reads as empty."""
    content = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(content).alias("k1"), F.xxhash64(F.lit("second"), content).alias("k2")]


def map_rows(frame: DataFrame, each: Callable[..., Iterator[tuple]], schema: str) -> DataFrame:
    """Rows that ``each(*row)`` yields, in Arrow batches of bounded length.

    ``each`` may be a function, or a class whose instances are called; the instance is made once a
    task, so that tables it builds are shared by the task's rows.
    """
    fields = _arrow(frame.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = each() if isinstance(each, type) else each
        out: list[tuple] = []
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            for row in zip(*columns):
                out.extend(call(*row))
                if len(out) >= ROWS_PER_BATCH:
                    yield to_batch(out, fields)
                    out = []
        if out:
            yield to_batch(out, fields)

    return frame.mapInArrow(run, schema)


ACCURACY = 10_000
"""Of the sketch that brackets a rank: it is wrong by at most one in so many rows."""


def kth_smallest(rows: DataFrame, value: str, k: int) -> Any:
    """The value of rank ``k``, from 0, among all values, exactly; there must be more than ``k``.

    A mergeable sketch brackets it, and only the different values inside the bracket, a few in ten
    thousand rows, are counted and looked at. A bracket that misses is widened.
    """
    n, margin = rows.where(F.col(value).isNotNull()).count(), 2 / ACCURACY
    while True:
        shares = [max(0.0, k / n - margin), min(1.0, (k + 1) / n + margin)]
        low, high = rows.agg(F.percentile_approx(value, shares, ACCURACY)).first()[0]
        below = rows.agg(F.count_if(F.col(value) < low)).first()[0]
        inside = rows.where(F.col(value).between(low, high)).groupBy(value).count().orderBy(value).collect()
        if below <= k < below + sum(r["count"] for r in inside):
            for r in inside:
                below += r["count"]
                if k < below:
                    return r[value]
        margin *= 4


def to_batch(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    columns: list[Any] = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)


def _arrow(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


arrow_schema = _arrow
