"""Customer segmentation by value, volume and category breadth, and the marts built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlens.functions.measures import MONEY, coverage_flag, money_sum, ratio
from orderlens.operators.abc import abc_class
from orderlens.operators.counted_join import join_counted
from orderlens.plans.context import BuildContext
from orderlens.plans.lines import eligible_lines


def customer_base(lines: DataFrame, products: DataFrame) -> DataFrame:
    """One row per person over the eligible lines. A line without a product still counts.

    Lines are reduced to one row per person and product before they meet the products, and orders are
    counted from one row per person and order, so no line is copied for a distinct count.
    """
    eligible = eligible_lines(lines)
    category = products.select("product_id", "category_name")
    known = F.when(F.col("category_name") != "unknown", F.col("category_name"))
    reduced = eligible.groupBy("customer_unique_id", "product_id").agg(
        F.count("*").alias("units"),
        F.sum("item_value_brl").cast(MONEY).alias("value"),
        F.sum("freight_value_brl").cast(MONEY).alias("freight"),
    )
    bought = (
        join_counted(reduced, category, "product_id", "left")
        .groupBy("customer_unique_id")
        .agg(
            F.sum("units").alias("units"),
            F.countDistinct("product_id").alias("distinct_products"),
            F.countDistinct(known).alias("distinct_categories"),
            money_sum(F.col("value")).alias("merchandise_gmv_brl"),
            money_sum(F.col("freight")).alias("freight_value_brl"),
        )
    )
    ordered = (
        eligible.groupBy("customer_unique_id", "order_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("customer_unique_id")
        .agg(F.count("order_id").alias("delivered_orders"))
    )
    return ordered.join(bought, "customer_unique_id")


def customer_segmentation(base: DataFrame, ctx: BuildContext) -> DataFrame:
    """Label every person of a materialized base in the three dimensions.

    No known category makes the row DIRECTIONAL: right in value and units, silent on breadth.
    """
    units, categories = F.col("units"), F.col("distinct_categories")
    segments = base.withColumns(
        {
            "value_segment": abc_class(base, "merchandise_gmv_brl"),
            "unit_segment": F.when(units == 1, "ONE_ITEM")
            .when(units.between(2, 3), "TWO_TO_THREE")
            .otherwise("FOUR_PLUS"),
            "category_segment": F.when(categories == 0, "UNKNOWN")
            .when(categories == 1, "SPECIALIST")
            .when(categories == 2, "MIXED")
            .otherwise("DIVERSIFIED"),
        }
    )
    status = F.when(F.col("category_segment") == "UNKNOWN", "DIRECTIONAL").otherwise("PUBLISHABLE")
    return segments.select(*ctx.tags(versioned=True), "*", status.alias("coverage_status"))


_SEGMENTS = ("value_segment", "unit_segment", "category_segment")


def _cells(segmentation: DataFrame) -> DataFrame:
    """Totals per combination of the three segments: at most 48 rows, one pass over the people."""
    return segmentation.groupBy(*_SEGMENTS).agg(
        F.count("*").alias("customers"),
        money_sum(F.col("merchandise_gmv_brl")).alias("merchandise_gmv_brl"),
        F.sum("units").alias("units"),
        F.sum("delivered_orders").alias("orders"),
        F.sum("distinct_categories").alias("categories"),
    )


def customer_segment_summary(segmentation: DataFrame, ctx: BuildContext) -> DataFrame:
    """Each person counted once in every dimension, from the segment cells instead of three scans."""
    dimension = F.explode(
        F.array(
            F.struct(F.lit("VALUE").alias("d"), F.col("value_segment").alias("l")),
            F.struct(F.lit("UNITS").alias("d"), F.col("unit_segment").alias("l")),
            F.struct(F.lit("CATEGORIES").alias("d"), F.col("category_segment").alias("l")),
        )
    )
    value = F.col("merchandise_gmv_brl")
    return (
        _cells(segmentation)
        .withColumn("dimension", dimension)
        .groupBy(F.col("dimension.d").alias("segment_dimension"), F.col("dimension.l").alias("segment_label"))
        .agg(
            F.sum("customers").alias("customers"),
            money_sum(value).alias("merchandise_gmv_brl"),
            F.sum("units").alias("units"),
            ratio(F.sum("orders"), F.sum("customers")).alias("avg_delivered_orders"),
            ratio(F.sum("categories"), F.sum("customers")).alias("avg_distinct_categories"),
        )
        .select(
            *ctx.tags(versioned=True),
            "*",
            ratio(value, F.sum(value).over(W.partitionBy("segment_dimension"))).alias("gmv_share"),
            F.lit("PUBLISHABLE").alias("coverage_status"),
        )
    )


def customer_cross_segment(segmentation: DataFrame, ctx: BuildContext) -> DataFrame:
    return _cells(segmentation).select(
        *ctx.tags(versioned=True),
        *_SEGMENTS,
        "customers",
        "merchandise_gmv_brl",
        "units",
        ratio(F.col("categories"), F.col("customers")).alias("avg_distinct_categories"),
        coverage_flag(F.col("customers")).alias("coverage_status"),
    )


def customer_category_affinity(
    lines: DataFrame, products: DataFrame, segmentation: DataFrame, ctx: BuildContext
) -> DataFrame:
    """What each value segment buys. All delivered lines of segmented people, of known products.

    Lines are reduced to one row per person and product before they meet the products, and to one per
    person and category before they meet the segments, so the people of a group are its rows and need
    no distinct count.
    """
    reduced = lines.groupBy("customer_unique_id", "product_id").agg(
        F.count("*").alias("units"), F.sum("item_value_brl").cast(MONEY).alias("value")
    )
    bought = (
        join_counted(reduced, products.select("product_id", "category_name"), "product_id")
        .groupBy("customer_unique_id", "category_name")
        .agg(F.sum("units").alias("units"), F.sum("value").cast(MONEY).alias("merchandise_gmv_brl"))
    )
    return (
        join_counted(bought, segmentation.select("customer_unique_id", "value_segment"), "customer_unique_id")
        .groupBy("value_segment", "category_name")
        .agg(
            F.count("*").alias("customers"),
            F.sum("units").alias("units"),
            money_sum(F.col("merchandise_gmv_brl")).alias("merchandise_gmv_brl"),
        )
        .select(*ctx.tags(), "*", coverage_flag(F.col("customers")).alias("coverage_status"))
    )
