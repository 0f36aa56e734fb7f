"""Star schema: raw text tables to typed dimensions and facts.

Nothing is repaired here. A value that does not parse becomes NULL, a product without a known
translation becomes ``unknown``, and the quality checks count both.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.display import month_label
from orderlens.functions.parsing import (
    blank_to_null,
    lower_text,
    parse_decimal,
    parse_double,
    parse_int,
    parse_timestamp,
    upper_text,
)
from orderlens.operators.counted_join import join_counted
from orderlens.operators.group_stats import group_median, group_mode


def dim_customer(raw_customers: DataFrame) -> DataFrame:
    """One row per person, with the number of order addresses seen. Blank ids are left out."""
    return (
        raw_customers.filter(blank_to_null(F.col("customer_unique_id")).isNotNull())
        .groupBy("customer_unique_id")
        .agg(F.countDistinct("customer_id").alias("observed_order_addresses"))
    )


def bridge_customer_order_address(raw_customers: DataFrame) -> DataFrame:
    """One row per order-level customer id. Blank person ids stay: they are people too."""
    return raw_customers.select(
        "customer_id",
        "customer_unique_id",
        parse_int(F.col("customer_zip_code_prefix")).alias("customer_zip_code_prefix"),
        blank_to_null(F.col("customer_city")).alias("customer_city"),
        upper_text(F.col("customer_state")).alias("customer_state"),
    )


def dim_geography(raw_geolocation: DataFrame) -> DataFrame:
    """One row per zip prefix: median position, most frequent city and state, points seen."""
    points = raw_geolocation.select(
        parse_int(F.col("geolocation_zip_code_prefix")).alias("zip_code_prefix"),
        parse_double(F.col("geolocation_lat")).alias("latitude"),
        parse_double(F.col("geolocation_lng")).alias("longitude"),
        blank_to_null(F.col("geolocation_city")).alias("city"),
        upper_text(F.col("geolocation_state")).alias("state"),
    ).filter(F.col("zip_code_prefix").isNotNull())
    positions = group_median(points, "zip_code_prefix", ["latitude", "longitude"], count="source_points")
    names = group_mode(points, "zip_code_prefix", ["city", "state"])
    return positions.join(names, "zip_code_prefix", "left").select(
        "zip_code_prefix", "latitude", "longitude", "city", "state", "source_points"
    )


def dim_product(raw_products: DataFrame, raw_translation: DataFrame) -> DataFrame:
    """Products with the translated category. The lookup uses the category text as delivered."""
    english = raw_translation.select(
        F.col("product_category_name").alias("category_key"),
        blank_to_null(F.col("product_category_name_english")).alias("english"),
    )
    matched = raw_products.join(
        english, raw_products["product_category_name"] == english["category_key"], "left"
    )
    return matched.select(
        "product_id",
        blank_to_null(F.col("product_category_name")).alias("category_name_pt"),
        F.coalesce("english", F.lit("unknown")).alias("category_name"),
        parse_int(F.col("product_photos_qty")).alias("photos_qty"),
        parse_double(F.col("product_weight_g")).alias("weight_g"),
        parse_double(F.col("product_length_cm")).alias("length_cm"),
        parse_double(F.col("product_height_cm")).alias("height_cm"),
        parse_double(F.col("product_width_cm")).alias("width_cm"),
    )


def dim_seller(raw_sellers: DataFrame) -> DataFrame:
    return raw_sellers.select(
        "seller_id",
        parse_int(F.col("seller_zip_code_prefix")).alias("seller_zip_code_prefix"),
        blank_to_null(F.col("seller_city")).alias("seller_city"),
        upper_text(F.col("seller_state")).alias("seller_state"),
    )


def fct_order(raw_orders: DataFrame, bridge: DataFrame) -> DataFrame:
    """Orders with typed times and, through the bridge, the person and address."""
    orders = raw_orders.select(
        "order_id",
        "customer_id",
        lower_text(F.col("order_status")).alias("order_status"),
        parse_timestamp(F.col("order_purchase_timestamp")).alias("purchased_at"),
        parse_timestamp(F.col("order_approved_at")).alias("approved_at"),
        parse_timestamp(F.col("order_delivered_carrier_date")).alias("delivered_carrier_at"),
        parse_timestamp(F.col("order_delivered_customer_date")).alias("delivered_customer_at"),
        parse_timestamp(F.col("order_estimated_delivery_date")).alias("estimated_delivery_at"),
    )
    return join_counted(orders, bridge, "customer_id", "left").select(
        "order_id",
        "customer_unique_id",
        "customer_id",
        "order_status",
        "purchased_at",
        "approved_at",
        "delivered_carrier_at",
        "delivered_customer_at",
        "estimated_delivery_at",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )


def fct_order_item(raw_order_items: DataFrame) -> DataFrame:
    return raw_order_items.select(
        "order_id",
        parse_int(F.col("order_item_id")).alias("order_item_id"),
        "product_id",
        "seller_id",
        parse_timestamp(F.col("shipping_limit_date")).alias("shipping_limit_at"),
        parse_decimal(F.col("price")).alias("item_value_brl"),
        parse_decimal(F.col("freight_value")).alias("freight_value_brl"),
    )


def fct_payment(raw_order_payments: DataFrame) -> DataFrame:
    return raw_order_payments.select(
        "order_id",
        parse_int(F.col("payment_sequential")).alias("payment_sequential"),
        lower_text(F.col("payment_type")).alias("payment_type"),
        parse_int(F.col("payment_installments")).alias("payment_installments"),
        parse_decimal(F.col("payment_value")).alias("payment_value_brl"),
    )


def fct_review(raw_order_reviews: DataFrame) -> DataFrame:
    return raw_order_reviews.select(
        "review_id",
        "order_id",
        parse_int(F.col("review_score")).alias("review_score"),
        blank_to_null(F.col("review_comment_title")).alias("review_comment_title"),
        blank_to_null(F.col("review_comment_message")).alias("review_comment_message"),
        parse_timestamp(F.col("review_creation_date")).alias("review_created_at"),
        parse_timestamp(F.col("review_answer_timestamp")).alias("review_answered_at"),
    )


def _days(bounds: DataFrame, first: str, last: str, name: str) -> DataFrame:
    """One row per day between two dates of a one-row frame."""
    days = F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))
    return bounds.filter(F.col(first).isNotNull()).select(F.explode(days).alias(name))


def dim_date(orders: DataFrame) -> DataFrame:
    """Every day between the first and last purchase of all orders, whatever the cut date."""
    bounds = orders.agg(
        F.min("purchased_at").cast("date").alias("first"),
        F.max("purchased_at").cast("date").alias("last"),
    )
    day = F.col("date_day")
    return _days(bounds, "first", "last", "date_day").select(
        "date_day",
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month_number"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.trunc(day, "month").alias("month_start"),
        F.quarter(day).cast("bigint").alias("quarter_number"),
        (F.dayofweek(day) - 1).cast("bigint").alias("weekday_number"),
    )


def calendar(executive_monthly: DataFrame) -> DataFrame:
    """Report calendar: from the first month to the last month or cut date, whichever is later.

    Column names are those the report model binds to.
    """
    bounds = executive_monthly.agg(
        F.min("month_start").alias("first"),
        F.greatest(F.max("month_start"), F.max("as_of_date")).alias("last"),
    )
    day = F.col("Fecha")
    return _days(bounds, "first", "last", "Fecha").select(
        "Fecha",
        F.year(day).cast("bigint").alias("Anio"),
        F.month(day).cast("bigint").alias("Mes numero"),
        (F.year(day) * 100 + F.month(day)).cast("bigint").alias("Mes indice"),
        month_label(day).alias("Mes"),
    )


def build_model(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All typed tables, by name."""
    bridge = bridge_customer_order_address(raw["raw_customers"])
    orders = fct_order(raw["raw_orders"], bridge)
    return {
        "dim_customer": dim_customer(raw["raw_customers"]),
        "bridge_customer_order_address": bridge,
        "dim_geography": dim_geography(raw["raw_geolocation"]),
        "dim_product": dim_product(raw["raw_products"], raw["raw_product_category_name_translation"]),
        "dim_seller": dim_seller(raw["raw_sellers"]),
        "fct_order": orders,
        "fct_order_item": fct_order_item(raw["raw_order_items"]),
        "fct_payment": fct_payment(raw["raw_order_payments"]),
        "fct_review": fct_review(raw["raw_order_reviews"]),
        "dim_date": dim_date(orders),
    }
