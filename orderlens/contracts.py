"""Input contracts and the constants the marts depend on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SCHEMA_VERSION = "1.0.0"
SEGMENTATION_VERSION = "CUSTOMER_VALUE_VOLUME_BREADTH_V1"

# A published group needs at least this many members.
MIN_COVERAGE = 30
# Cumulative value share, before the bucket, below which a customer is A, then B.
VALUE_CUTS = (0.80, 0.95)

FAILED_STATUSES = ("canceled", "unavailable")


@dataclass(frozen=True)
class RawTable:
    """One landing file: exact header, in order, every column read as text.

    ``free_text`` marks files whose quoted fields may hold line breaks. Spark cannot split such a
    file, so only the file that needs it is read that way.
    """

    file: str
    table: str
    columns: tuple[str, ...]
    free_text: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


# File names and headers of the landing contract, spelled as the files spell them.
RAW_TABLES = (
    RawTable(
        "olist_customers_dataset.csv",
        "raw_customers",
        ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
    ),
    RawTable(
        "olist_geolocation_dataset.csv",
        "raw_geolocation",
        (
            "geolocation_zip_code_prefix",
            "geolocation_lat",
            "geolocation_lng",
            "geolocation_city",
            "geolocation_state",
        ),
    ),
    RawTable(
        "olist_order_items_dataset.csv",
        "raw_order_items",
        (
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            "shipping_limit_date",
            "price",
            "freight_value",
        ),
    ),
    RawTable(
        "olist_order_payments_dataset.csv",
        "raw_order_payments",
        ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
    ),
    RawTable(
        "olist_order_reviews_dataset.csv",
        "raw_order_reviews",
        (
            "review_id",
            "order_id",
            "review_score",
            "review_comment_title",
            "review_comment_message",
            "review_creation_date",
            "review_answer_timestamp",
        ),
        free_text=True,
    ),
    RawTable(
        "olist_orders_dataset.csv",
        "raw_orders",
        (
            "order_id",
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            "order_approved_at",
            "order_delivered_carrier_date",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        ),
    ),
    RawTable(
        "olist_products_dataset.csv",
        "raw_products",
        (
            "product_id",
            "product_category_name",
            "product_name_lenght",
            "product_description_lenght",
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
        ),
    ),
    RawTable(
        "olist_sellers_dataset.csv",
        "raw_sellers",
        ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    ),
    RawTable(
        "product_category_name_translation.csv",
        "raw_product_category_name_translation",
        ("product_category_name", "product_category_name_english"),
    ),
)
RAW_BY_TABLE = {raw.table: raw for raw in RAW_TABLES}
