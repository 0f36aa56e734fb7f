"""Run registered queries next to their SQL and compare every value.

    python -m registry.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import sys
import tempfile
import time
from collections import Counter
from decimal import Decimal

import duckdb

from orderlens.session import discard
from registry.oracle import ORACLE
from registry.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return value.normalize() + 0
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(repr(tuple(_plain(row[i]) for i in order)) for row in rows)


def difference(connection, name: str, frame) -> tuple[str, int]:
    """What differs between a query's frame and its SQL, empty when nothing does, and the rows."""
    got = frame.collect()
    if name not in ORACLE:
        return "", len(got)
    result = connection.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}", len(got)
    ours, theirs = _rows(frame.columns, got), _rows(columns, expected)
    if ours != theirs:
        samples = f"only ours {list(ours - theirs)[:3]}; only theirs {list(theirs - ours)[:3]}"
        return f"{len(got)} rows against {len(expected)}; {samples}", len(got)
    return "", len(got)


def main(sf_dir: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="orderlens-compare-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    wrong = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem, rows = difference(connection, name, QUERIES[name](spark, sf_dir))
        except Exception as error:
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        wrong += bool(problem)
        checked = "sql " if name in ORACLE else "rows"
        took = time.time() - start
        print(f"{'BAD' if problem else 'ok '} {checked} {name} rows={rows} {took:.1f}s {problem}", flush=True)
    discard(spark)
    spark.stop()
    return wrong


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
