"""A table of many rows is never sent whole to every task, however small its files look."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from orderlens.operators import counted_join, group_stats
from orderlens.operators.counted_join import join_counted
from orderlens.plans import model, performance, segmentation
from orderlens.plans.context import BuildContext

CTX = BuildContext(date(2018, 12, 31), "b")


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def _lines(spark):
    n = F.col("id")
    return spark.range(60).select(
        (n % 20).cast("string").alias("order_id"),
        F.concat(F.lit("u"), (n % 7).cast("string")).alias("customer_unique_id"),
        (n % 11).cast("string").alias("product_id"),
        (n % 5).cast("string").alias("seller_id"),
        n.cast("decimal(18,2)").alias("item_value_brl"),
        F.lit(1).cast("decimal(18,2)").alias("freight_value_brl"),
        F.lit(4.0).alias("review_score"),
        F.lit(False).alias("is_late"),
    )


def _products(spark):
    return spark.range(9).select(F.col("id").cast("string").alias("product_id"), F.lit("home").alias("category_name"))


def _sellers(spark):
    return spark.range(9).select(F.col("id").cast("string").alias("seller_id"), F.lit("SP").alias("seller_state"))


def _segments(spark):
    return spark.range(7).select(
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("customer_unique_id"), F.lit("A").alias("value_segment")
    )


def _orders(spark):
    text = lambda *names: [F.lit("").alias(name) for name in names]
    raw = spark.range(9).select(
        F.col("id").cast("string").alias("order_id"),
        F.col("id").cast("string").alias("customer_id"),
        *text("order_status", "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date"),
        *text("order_delivered_customer_date", "order_estimated_delivery_date"),
    )
    people = spark.range(9).select(
        F.col("id").cast("string").alias("customer_id"),
        F.lit("u").alias("customer_unique_id"),
        *text("customer_zip_code_prefix", "customer_city", "customer_state"),
    )
    return model.fct_order(raw, model.bridge_customer_order_address(people))


MARTS = {
    "base": lambda s: segmentation.customer_base(_lines(s), _products(s)),
    "affinity": lambda s: segmentation.customer_category_affinity(_lines(s), _products(s), _segments(s), CTX),
    "category": lambda s: performance.category_performance(_lines(s), _products(s), CTX),
    "seller": lambda s: performance.seller_performance(_lines(s), _sellers(s), CTX),
    "orders": _orders,
}


@pytest.mark.parametrize("name", MARTS)
def test_a_dimension_of_many_rows_is_merged_not_broadcast(spark, monkeypatch, name):
    few = MARTS[name](spark)
    assert "BroadcastHashJoin" in _plan(few)
    monkeypatch.setattr(counted_join, "BROADCAST_ROWS", 6)
    many = MARTS[name](spark)
    rows = sorted(map(str, many.collect()))
    assert rows and rows == sorted(map(str, few.collect()))
    dimension_joins = [line for line in _plan(many).split("\n") if "BroadcastHashJoin" in line and "customer_unique_id" not in line]
    assert not dimension_joins and "SortMergeJoin" in _plan(many)


def test_the_rows_of_a_median_are_never_broadcast(spark):
    points = spark.range(1_000).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v_0"))
    read = points.withColumnRenamed("k", "key")
    value = F.col("v_0")
    bracket = F.struct(
        F.count("v_0").alias("size"), F.count("v_0").alias("ordered"), F.min("v_0").alias("low"),
        F.max("v_0").alias("high"), F.min("v_0").alias("least"), F.max("v_0").alias("most"),
    )
    brackets = read.groupBy("key").agg(bracket.alias("b_0"))
    plan = _plan(group_stats._counted(read, brackets, [value]))
    assert "BuildLeft" not in plan and "LeftOuter" in plan


def test_a_frame_that_is_cheaper_to_count_may_be_given(spark, monkeypatch):
    monkeypatch.setattr(counted_join, "BROADCAST_ROWS", 4)
    left, right = spark.range(9).withColumnRenamed("id", "k"), spark.range(3).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in _plan(join_counted(left, right, "k"))
    merged = join_counted(left, right, "k", "left", counted=left)
    assert "SortMergeJoin" in _plan(merged) and merged.count() == 9
