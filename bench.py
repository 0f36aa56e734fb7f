"""Time the headline queries: one JSON line on standard output.

Each query runs once to warm up and is then timed from building its frame to writing every row of
the result to a sink that discards them.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlens.session import discard  # noqa: E402
from registry.queries import QUERIES  # noqa: E402

HEADLINE = (
    "fct_order",
    "dim_geography",
    "order_summary",
    "executive_monthly",
    "customer_base",
    "customer_segmentation",
    "customer_segment_summary",
    "customer_category_affinity",
    "category_performance",
    "seller_performance",
    "delivery_experience",
    "quality_checks",
    "executive_facts",
)


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("orderlens-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="orderlens-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    for name in names:
        run(spark, name, sf_dir)
    seconds = {name: round(run(spark, name, sf_dir), 3) for name in names}
    discard(spark)
    spark.stop()
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
