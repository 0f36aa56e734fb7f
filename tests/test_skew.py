"""A third of all rows on one key: results stay whole, and the work on the key is split."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import date

import pytest
from pyspark.sql import functions as F

from orderlens.operators.hot_join import PART, hot_keys, join_hot
from orderlens.plans import lines, orders, performance, quality, segmentation
from orderlens.plans.context import BuildContext
from orderlens.session import materialize

CTX = BuildContext(date(2018, 12, 31), "b")
ITEMS = 60_000


@contextmanager
def _conf(spark, **settings):
    """Small thresholds, so that local data is as skewed as large data."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


_SPLIT = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "65536",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "65536",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def hot(spark):
    """Orders and items where every third item is of order 0, product 0, seller 0 and person 0."""
    n = F.col("id")
    order_id = F.when(n % 3 == 0, F.lit(0)).otherwise(n % 4_000 + 1).cast("long")
    items = spark.range(0, ITEMS, 1, 6).select(
        order_id.alias("order_id"),
        (n % 7).cast("int").alias("order_item_id"),
        F.when(n % 3 == 0, n % 5_000).otherwise(0).alias("product_id"),
        F.when(n % 3 == 1, 0).otherwise(n % 900).cast("long").alias("seller_id"),
        ((n % 977) / 4).cast("decimal(18,2)").alias("item_value_brl"),
        F.lit(1).cast("decimal(18,2)").alias("freight_value_brl"),
    )
    o = F.col("id")
    bought = F.lit("2018-01-01 10:00:00").cast("timestamp_ntz")
    heads = spark.range(0, 4_001).select(
        o.alias("order_id"),
        F.when(o % 3 == 0, "u0").otherwise(F.concat(F.lit("u"), (o % 500).cast("string"))).alias("customer_unique_id"),
        F.lit("delivered").alias("order_status"),
        bought.alias("purchased_at"),
        (o % 5).cast("double").alias("review_score"),
        (o % 2 == 0).alias("is_late"),
    )
    products = spark.range(0, 5_000).select(
        o.alias("product_id"),
        F.when(o % 10 == 0, "unknown").otherwise(F.concat(F.lit("c"), (o % 9).cast("string"))).alias("category_name"),
    )
    sellers = spark.range(0, 900).select(o.alias("seller_id"), F.lit("SP").alias("seller_state"))
    return {"orders": heads, "items": items, "products": products, "sellers": sellers}


def _frames(hot):
    joined = lines.delivered_lines(hot["orders"], hot["items"], CTX)
    base = segmentation.customer_base(joined, hot["products"])
    return {
        "items_by_order": orders.items_by_order(hot["items"]),
        "lines": joined.groupBy("order_id").agg(F.count("*").alias("n"), F.sum("item_value_brl").alias("v")),
        "base": base,
        "category": performance.category_performance(joined, hot["products"], CTX),
        "seller": performance.seller_performance(joined, hot["sellers"], CTX),
        "orphans": quality.orphan_rows(hot["items"], hot["products"].filter("product_id % 2 = 1"), "product_id"),
        "affinity": segmentation.customer_category_affinity(
            joined, hot["products"], segmentation.customer_segmentation(materialize(base), CTX), CTX
        ),
    }


def test_results_do_not_depend_on_how_joins_are_split(spark, hot):
    plain = {name: sorted(map(str, frame.collect())) for name, frame in _frames(hot).items()}
    with _conf(spark, **_SPLIT):
        split = {name: sorted(map(str, frame.collect())) for name, frame in _frames(hot).items()}
    assert plain == split
    assert len(plain["items_by_order"]) == hot["items"].select("order_id").distinct().count()


def test_the_hot_order_is_whole(spark, hot):
    row = orders.items_by_order(hot["items"]).filter("order_id = 0").first()
    n = [i for i in range(ITEMS) if i % 3 == 0]
    assert row.units == len(n) == ITEMS // 3
    assert row.distinct_products == len({i % 5_000 for i in n})
    assert row.distinct_sellers == len({i % 900 for i in n})


def _summary(spark, hot):
    """The order summary, not stored: a join that is partitioned by the order already."""
    n = F.col("id")
    payments = spark.range(0, 9_000).select(
        (n % 4_001).alias("order_id"), F.lit("card").alias("payment_type"), F.lit(1).cast("decimal(18,2)").alias("payment_value_brl")
    )
    reviews = spark.range(0, 4_001).select(n.alias("order_id"), (n % 5 + 1).cast("int").alias("review_score"))
    times = ("approved_at", "delivered_carrier_at", "delivered_customer_at", "estimated_delivery_at")
    heads = hot["orders"].drop("review_score", "is_late").withColumns({c: F.col("purchased_at") for c in times})
    return orders.order_summary(heads, hot["items"], payments, reviews)


def _most_in_a_task(frame) -> float:
    counted = frame.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    return max(r.n for r in counted) / sum(r.n for r in counted)


def test_the_join_of_a_hot_order_is_split_whatever_stands_below_it(spark, hot):
    """A third of the items are one order's; no task joins more than a fifth of them all."""
    unsplit = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    with _conf(spark, **_SPLIT | unsplit):
        joined = lines.delivered_lines(_summary(spark, hot), hot["items"], CTX)
        assert _most_in_a_task(joined) < 0.2
        plain = lines.delivered_orders(_summary(spark, hot), CTX).join(hot["items"], "order_id")
        assert _most_in_a_task(plain) > 0.33
        key = ["order_id", "product_id", "seller_id", "item_value_brl"]
        assert joined.select(key).exceptAll(plain.select(key)).isEmpty()
        assert joined.count() == plain.count() == ITEMS


def test_frequent_keys_are_found_and_no_others(spark, hot):
    found = hot_keys(hot["items"], "order_id", 8)
    assert set(found) == {0} and 10 <= found[0] <= 12
    assert hot_keys(hot["items"].filter("order_id <> 0"), "order_id", 8) == {}
    assert hot_keys(hot["items"].limit(0), "order_id", 8) == {}
    nulls = hot["items"].select(F.when(F.col("order_id") != 0, F.col("order_id")).alias("order_id"))
    assert hot_keys(nulls, "order_id", 8) == {}


def test_a_join_without_frequent_keys_is_the_plain_one(spark, hot):
    few = hot["items"].filter("order_id <> 0")
    plan = join_hot(hot["orders"], few, "order_id", parts=8)._jdf.queryExecution().executedPlan().toString()
    assert PART not in plan
    salted = join_hot(hot["orders"], hot["items"], "order_id", hot={0: 5, 3: 2})
    assert PART not in salted.columns
    assert salted.count() == ITEMS


def test_distinct_counts_of_a_hot_key_are_spread_by_value(spark, hot):
    plan = orders.items_by_order(hot["items"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert plan.count("hashpartitioning(order_id") == 4
    for value in ("product_id", "seller_id"):
        assert any("hashpartitioning(order_id" in line and value in line for line in plan.split("\n"))


def test_facts_without_a_frequent_order_are_dealt_once(spark, hot):
    """Items move once and payments once; the counts are those of the plan for frequent orders."""
    items = hot["items"].filter("order_id <> 0").withColumn(
        "product_id", F.when(F.col("seller_id") % 5 != 0, F.col("product_id") + F.col("seller_id") % 3)
    )
    payments = items.select(
        "order_id", F.concat(F.lit("t"), F.col("seller_id") % 4).alias("payment_type"), F.col("item_value_brl").alias("payment_value_brl")
    )
    for by_order, rows in ((orders.items_by_order, items), (orders.payments_by_order, payments)):
        dealt, moved = by_order(rows), by_order(rows, stored_by_order=True)
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(order_id") == 1
        assert "REPARTITION" not in moved._jdf.queryExecution().executedPlan().toString()
        assert dealt.dtypes == moved.dtypes
        assert sorted(map(str, dealt.collect())) == sorted(map(str, moved.collect()))
        assert dealt.count() == rows.select("order_id").distinct().count()
