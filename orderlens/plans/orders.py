"""Order grain and the marts that read it.

Each one-to-many fact is reduced to one row per order before any join, so no join multiplies rows.
The steps are separate so that a mart joins only the facts it uses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.contracts import FAILED_STATUSES
from orderlens.functions.measures import (
    MONEY,
    coverage_flag,
    mean,
    money_sum,
    month_start,
    on_or_before,
    rate,
)
from orderlens.operators.hot_join import hot_keys
from orderlens.plans.context import BuildContext

ORDER_SHARES = 1_024
"""A fact is dealt by the order unless some order holds more than one of so many equal shares of its rows."""


def is_delivered() -> Column:
    return F.col("order_status") == "delivered"


def _worth_dealing(rows: DataFrame, stored_by_order: bool) -> bool:
    """Whether to deal a fact by the order: not where an order has a great part of the rows, nor where
    the rows lie by the order already."""
    return not stored_by_order and not hot_keys(rows, "order_id", ORDER_SHARES)


def _distinct(value: str) -> Column:
    """Distinct values counted as a set, in rows dealt by the order: each order's set is small."""
    return F.size(F.collect_set(value)).cast("bigint")


def _item_totals(distinct_products: Column) -> list[Column]:
    return [
        F.count("*").alias("units"),
        distinct_products.alias("distinct_products"),
        money_sum(F.col("item_value_brl")).alias("merchandise_gmv_brl"),
        money_sum(F.col("freight_value_brl")).alias("freight_value_brl"),
    ]


def items_by_order(items: DataFrame, stored_by_order: bool = False) -> DataFrame:
    """Units, distinct products and sellers, value and freight of each order.

    Items are dealt by the order once, and all is counted where they are. Where an order holds a great part
    of them, it is two aggregates with one distinct count each. Asked for both at once, Spark copies every
    item three times before the shuffle; the second scan here reads two columns and moves half as much.
    There a distinct count is spread over (order, value), so a huge order is no single task."""
    if _worth_dealing(items, stored_by_order):
        dealt = items.select("order_id", "product_id", "seller_id", "item_value_brl", "freight_value_brl")
        totals = dealt.repartition("order_id").groupBy("order_id").agg(
            *_item_totals(_distinct("product_id")), _distinct("seller_id").alias("distinct_sellers")
        )
    else:
        totals = items.groupBy("order_id").agg(*_item_totals(F.countDistinct("product_id")))
        sellers = items.groupBy("order_id").agg(F.countDistinct("seller_id").alias("distinct_sellers"))
        totals = totals.join(sellers, "order_id", "left")
    return totals.select(
        "order_id",
        "units",
        "distinct_products",
        "distinct_sellers",
        "merchandise_gmv_brl",
        "freight_value_brl",
    )


def payments_by_order(payments: DataFrame, stored_by_order: bool = False) -> DataFrame:
    """Value, number and kinds of the payments of each order, dealt as the items are."""
    methods = F.countDistinct("payment_type")
    if _worth_dealing(payments, stored_by_order):
        payments = payments.select("order_id", "payment_type", "payment_value_brl").repartition("order_id")
        methods = _distinct("payment_type")
    return payments.groupBy("order_id").agg(
        money_sum(F.col("payment_value_brl")).alias("paid_value_brl"),
        F.count("*").alias("payment_rows"),
        methods.alias("payment_methods"),
    )


def reviews_by_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        mean(F.col("review_score")).alias("review_score"),
        F.count("*").alias("review_rows"),
    )


def _zero_when_missing(frame: DataFrame, columns: list[str]) -> DataFrame:
    zero = {c: F.lit(0).cast(frame.schema[c].dataType) for c in columns}
    return frame.withColumns({c: F.coalesce(c, zero[c]) for c in columns})


def with_items(orders: DataFrame, items: DataFrame, stored_by_order: bool = False) -> DataFrame:
    """Units, distinct products and sellers, value and freight; an order without items has zeros."""
    totals = items_by_order(items, stored_by_order)
    return _zero_when_missing(orders.join(totals, "order_id", "left"), totals.columns[1:])


def with_payments(orders: DataFrame, payments: DataFrame, stored_by_order: bool = False) -> DataFrame:
    totals = payments_by_order(payments, stored_by_order)
    return _zero_when_missing(orders.join(totals, "order_id", "left"), totals.columns[1:])


def with_reviews(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Average score and number of reviews; an order without reviews has a NULL score."""
    totals = reviews_by_order(reviews)
    return _zero_when_missing(orders.join(totals, "order_id", "left"), ["review_rows"])


def with_delivery(orders: DataFrame) -> DataFrame:
    """Delay in days crossed, and lateness by the clock; NULL unless delivered with both times.

    The two differ on purpose: delivered in the afternoon of the promised day is late by zero days.
    """
    known = is_delivered() & F.col("delivered_customer_at").isNotNull() & F.col("estimated_delivery_at").isNotNull()
    delay = F.datediff(F.col("delivered_customer_at").cast("date"), F.col("estimated_delivery_at").cast("date"))
    late = F.col("delivered_customer_at") > F.col("estimated_delivery_at")
    return orders.withColumns(
        {
            "delivery_delay_days": F.when(known, delay.cast("bigint")),
            "is_late": F.when(known, late),
        }
    )


def invalid_chronology() -> Column:
    """An order approved or delivered before it can have been; NULL where times are missing."""
    return (
        (F.col("approved_at") < F.col("purchased_at"))
        | (F.col("delivered_customer_at") < F.col("purchased_at"))
        | (F.col("delivered_customer_at") < F.col("delivered_carrier_at"))
    )


def order_summary(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame, stored_by_order: bool = False
) -> DataFrame:
    """One row per order with everything known about it. Not cut at the as-of date.
    ``stored_by_order`` says that items and payments lie by the order, as in a warehouse with buckets."""
    summary = with_items(orders, items, stored_by_order)
    summary = with_payments(summary, payments, stored_by_order)
    summary = with_reviews(summary, reviews)
    return with_delivery(summary)


def executive_monthly(summary: DataFrame, ctx: BuildContext) -> DataFrame:
    """Purchase months up to the cut. Money, units, reviews and lateness count delivered orders only
    and are NULL in a month without any; the late rate keeps orders with an invalid chronology."""
    delivered = is_delivered()
    return (
        summary.filter(on_or_before(F.col("purchased_at"), ctx.as_of))
        .groupBy(month_start(F.col("purchased_at")).alias("month_start"))
        .agg(
            F.count("*").alias("orders"),
            F.countDistinct("customer_unique_id").alias("customers"),
            F.count_if(delivered).alias("delivered_orders"),
            F.count_if(F.col("order_status").isin(*FAILED_STATUSES)).alias("failed_orders"),
            money_sum(F.col("merchandise_gmv_brl"), delivered).alias("merchandise_gmv_brl"),
            money_sum(F.col("freight_value_brl"), delivered).alias("freight_value_brl"),
            F.sum(F.when(delivered, F.col("units"))).alias("units"),
            mean(F.col("merchandise_gmv_brl"), delivered).alias("avg_order_value_brl"),
            mean(F.col("review_score"), delivered).alias("avg_review_score"),
            rate(F.col("is_late"), delivered).alias("late_delivery_rate"),
        )
        .select(*ctx.tags(), "*")
    )


def delivery_experience(summary: DataFrame, ctx: BuildContext) -> DataFrame:
    """Delivered orders by purchase month and status, without invalid chronologies. The review is
    averaged per order; an order whose lateness is not known is UNKNOWN."""
    status = F.when(F.col("is_late"), "LATE").when(~F.col("is_late"), "ON_TIME").otherwise("UNKNOWN")
    return (
        summary.filter(is_delivered())
        .filter(on_or_before(F.col("purchased_at"), ctx.as_of))
        .filter(~F.coalesce(invalid_chronology(), F.lit(False)))
        .groupBy(month_start(F.col("purchased_at")).alias("month_start"), status.alias("delivery_status"))
        .agg(
            F.count("*").alias("orders"),
            mean(F.col("review_score")).alias("avg_review_score"),
            mean(F.col("delivery_delay_days")).alias("avg_delivery_delay_days"),
            F.count("review_score").alias("reviewed_orders"),
        )
        .select(*ctx.tags(), "*", coverage_flag(F.col("orders")).alias("coverage_status"))
    )
