"""Category and seller performance over delivered lines.

Review scores and lateness are weighted by items here: an order's score counts once per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.measures import MONEY, coverage_flag, money_sum, ratio
from orderlens.operators.counted_join import join_counted
from orderlens.plans.context import BuildContext


def _per_order(lines: DataFrame, *keys: str) -> DataFrame:
    """Lines reduced to one row per key and order, sums and counts kept apart for the averages."""
    return lines.groupBy(*keys, "order_id").agg(
        F.count("*").alias("units"),
        F.sum("item_value_brl").cast(MONEY).alias("gmv"),
        F.count("item_value_brl").alias("valued"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("scored"),
        F.count_if("is_late").alias("late"),
        F.count("is_late").alias("timed"),
    )


def category_performance(lines: DataFrame, products: DataFrame, ctx: BuildContext) -> DataFrame:
    """Lines of known products by category. Lines are one row per product, person and order before they
    meet the products, so a hot product is joined once an order; after the second reduction every row
    is one order of the category, so only the people still need a distinct count."""
    reduced = _per_order(lines, "product_id", "customer_unique_id")
    named = join_counted(reduced, products.select("product_id", "category_name"), "product_id")
    sums = ["units", "valued", "score_sum", "scored"]
    return (
        named.groupBy("category_name", "customer_unique_id", "order_id")
        .agg(F.sum("gmv").cast(MONEY).alias("gmv"), *[F.sum(c).alias(c) for c in sums])
        .groupBy("category_name")
        .agg(
            F.sum("units").alias("units"),
            F.count("*").alias("orders"),
            F.countDistinct("customer_unique_id").alias("customers"),
            money_sum(F.col("gmv")).alias("merchandise_gmv_brl"),
            ratio(F.sum("gmv"), F.sum("valued")).alias("avg_item_value_brl"),
            ratio(F.sum("score_sum"), F.sum("scored")).alias("avg_review_score"),
        )
        .select(*ctx.tags(), "*", coverage_flag(F.col("orders")).alias("coverage_status"))
    )


def seller_performance(lines: DataFrame, sellers: DataFrame, ctx: BuildContext) -> DataFrame:
    """Lines by seller and state, sellers unknown to the dimension left out.

    The lines are reduced to one row per seller before the dimension is joined. A seller listed
    more than once in a state weighs its units and value that many times, as a join of the lines
    would; its orders and averages do not change.
    """
    listed = sellers.groupBy("seller_id", "seller_state").agg(F.count("*").alias("listings"))
    totals = (
        _per_order(lines, "seller_id")
        .groupBy("seller_id")
        .agg(
            F.count("*").alias("orders"),
            F.sum("units").alias("units"),
            money_sum(F.col("gmv")).alias("gmv"),
            ratio(F.sum("score_sum"), F.sum("scored")).alias("avg_review_score"),
            ratio(F.sum("late"), F.sum("timed")).alias("late_delivery_rate"),
        )
    )
    return join_counted(totals, listed, "seller_id", counted=sellers).select(
        *ctx.tags(),
        "seller_id",
        "seller_state",
        "orders",
        (F.col("units") * F.col("listings")).alias("units"),
        (F.col("gmv") * F.col("listings")).cast(MONEY).alias("merchandise_gmv_brl"),
        "avg_review_score",
        "late_delivery_rate",
        coverage_flag(F.col("orders")).alias("coverage_status"),
    )
