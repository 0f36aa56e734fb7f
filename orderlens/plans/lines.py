"""Delivered order lines: the one large join that the item-grain marts share.

An item row with its order's person, review and lateness, for delivered orders up to the cut. The
build writes this table once; segmentation, affinity, category and seller marts and the value
reconciliation read it instead of joining orders to items again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.measures import on_or_before
from orderlens.operators.hot_join import join_hot
from orderlens.plans.context import BuildContext
from orderlens.plans.orders import is_delivered

_ORDER_COLUMNS = ("order_id", "customer_unique_id", "review_score", "is_late")
_ITEM_COLUMNS = ("order_id", "product_id", "seller_id", "item_value_brl", "freight_value_brl")


def delivered_orders(orders: DataFrame, ctx: BuildContext) -> DataFrame:
    return orders.filter(is_delivered() & on_or_before(F.col("purchased_at"), ctx.as_of))


def delivered_lines(orders: DataFrame, items: DataFrame, ctx: BuildContext) -> DataFrame:
    """Items of delivered orders. ``orders`` is the order summary, or any frame of orders; review
    score and lateness are carried where it has them. An order that holds a great part of all items is
    split among tasks, whatever the frames are made from."""
    kept = [c for c in _ORDER_COLUMNS if c in orders.columns]
    joined = join_hot(delivered_orders(orders, ctx).select(*kept), items.select(*_ITEM_COLUMNS, "order_item_id"), "order_id")
    return joined.drop("order_item_id")


def eligible_lines(lines: DataFrame) -> DataFrame:
    """Lines that count for segmentation: a known person and a value that is not negative."""
    return lines.filter((F.col("item_value_brl") >= 0) & F.col("customer_unique_id").isNotNull())
