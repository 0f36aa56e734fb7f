"""The star-schema sample tables read as the canonical model, typed or as raw text.

The sample has orders, lines, customers, suppliers, parts and events, and no payments, reviews or
delivery times; those are derived from what is there by fixed arithmetic on keys and values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Sample:
    """Canonical tables over ``<sf_dir>/<table>.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._read: dict[str, DataFrame] = {}

    def read(self, table: str) -> DataFrame:
        """Each table's footers are read once."""
        if table not in self._read:
            self._read[table] = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
        return self._read[table]

    def _nations(self) -> DataFrame:
        return self.read("nation").select("n_nationkey", "n_name")

    # typed tables

    def bridge(self) -> DataFrame:
        customers = self.read("customer").join(self._nations(), F.col("c_nationkey") == F.col("n_nationkey"))
        return (
            self.read("orders")
            .join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                F.col("o_orderkey").alias("customer_id"),
                _person().alias("customer_unique_id"),
                F.col("c_nationkey").alias("customer_zip_code_prefix"),
                F.col("c_mktsegment").alias("customer_city"),
                F.upper("n_name").alias("customer_state"),
            )
        )

    def order_times(self) -> DataFrame:
        """Orders without person and address."""
        day = F.col("o_orderdate").cast("date")
        arrived = F.date_add(day, (F.col("o_orderkey") % 45).cast("int")).cast("timestamp_ntz")
        delivered = (F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 50 != 0)
        status = F.when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "O", "shipped")
        return self.read("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderkey").alias("customer_id"),
            status.otherwise("canceled").alias("order_status"),
            F.col("o_orderdate").alias("purchased_at"),
            (F.col("o_orderdate") + F.expr("interval 1 hour")).alias("approved_at"),
            (F.col("o_orderdate") + F.expr("interval 2 days")).alias("delivered_carrier_at"),
            F.when(delivered, arrived).alias("delivered_customer_at"),
            (F.col("o_orderdate") + F.expr("interval 30 days")).alias("estimated_delivery_at"),
        )

    def orders(self) -> DataFrame:
        """Orders with person and address through the bridge."""
        return self.order_times().join(self.bridge(), "customer_id", "left").select(
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

    def person_orders(self) -> DataFrame:
        """Orders with the person and no address: what the marts read."""
        person = F.concat(F.lit("u"), (F.col("order_id") - F.col("order_id") % 3).cast("string"))
        return self.order_times().withColumn("customer_unique_id", person)

    def items(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_at"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("item_value_brl"),
            F.col("l_quantity").cast("decimal(18,2)").alias("freight_value_brl"),
        )

    def payments(self) -> DataFrame:
        paid = F.col("l_extendedprice").cast("decimal(18,2)") + F.col("l_quantity").cast("decimal(18,2)")
        short = F.when(F.col("l_orderkey") % 20 == 0, F.lit("1.50").cast("decimal(18,2)"))
        value = paid - F.coalesce(short, F.lit("0.00").cast("decimal(18,2)"))
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            F.lower("l_returnflag").alias("payment_type"),
            F.col("l_quantity").cast("int").alias("payment_installments"),
            value.cast("decimal(18,2)").alias("payment_value_brl"),
        )

    def reviews(self) -> DataFrame:
        return self.read("events").select(
            F.col("event_id").alias("review_id"),
            (F.col("event_id") + F.col("event_id") % 2).alias("order_id"),
            _score().alias("review_score"),
            F.col("ts").alias("review_created_at"),
        )

    def products(self) -> DataFrame:
        kind = F.col("p_type")
        return self.read("part").select(
            F.col("p_partkey").alias("product_id"),
            kind.alias("category_name_pt"),
            F.when(kind == "PROMO", "unknown").otherwise(F.lower(kind)).alias("category_name"),
        )

    def sellers(self) -> DataFrame:
        return (
            self.read("supplier")
            .join(self._nations(), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("seller_id"),
                F.col("s_nationkey").alias("seller_zip_code_prefix"),
                F.upper("n_name").alias("seller_state"),
            )
        )

    # raw text tables

    def raw_customers(self) -> DataFrame:
        customers = self.read("customer").join(self._nations(), F.col("c_nationkey") == F.col("n_nationkey"))
        return (
            self.read("orders")
            .join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .select(
                _text("o_orderkey").alias("customer_id"),
                _person().alias("customer_unique_id"),
                _text("c_nationkey").alias("customer_zip_code_prefix"),
                F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")).alias("customer_city"),
                F.lower("n_name").alias("customer_state"),
            )
        )

    def raw_geolocation(self) -> DataFrame:
        return (
            self.read("customer")
            .join(self._nations(), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                _text("c_nationkey").alias("geolocation_zip_code_prefix"),
                (F.col("c_acctbal") / 100).cast("string").alias("geolocation_lat"),
                (-F.col("c_acctbal") / 50).cast("string").alias("geolocation_lng"),
                F.col("c_mktsegment").alias("geolocation_city"),
                F.lower("n_name").alias("geolocation_state"),
            )
        )

    def raw_orders(self) -> DataFrame:
        status = F.when(F.col("order_status") == "delivered", " Delivered").otherwise(F.upper("order_status"))
        return self.order_times().select(
            _text("order_id").alias("order_id"),
            _text("customer_id").alias("customer_id"),
            status.alias("order_status"),
            _text("purchased_at").alias("order_purchase_timestamp"),
            _text("approved_at").alias("order_approved_at"),
            _text("delivered_carrier_at").alias("order_delivered_carrier_date"),
            _text("delivered_customer_at").alias("order_delivered_customer_date"),
            _text("estimated_delivery_at").alias("order_estimated_delivery_date"),
        )

    def raw_order_items(self) -> DataFrame:
        return self.read("lineitem").select(
            _text("l_orderkey").alias("order_id"),
            _text("l_linenumber").alias("order_item_id"),
            _text("l_partkey").alias("product_id"),
            _text("l_suppkey").alias("seller_id"),
            _text("l_shipdate").alias("shipping_limit_date"),
            _text("l_extendedprice").alias("price"),
            _text("l_quantity").alias("freight_value"),
        )

    def raw_order_payments(self) -> DataFrame:
        return self.read("lineitem").select(
            _text("l_orderkey").alias("order_id"),
            _text("l_linenumber").alias("payment_sequential"),
            F.col("l_returnflag").alias("payment_type"),
            _text("l_quantity").alias("payment_installments"),
            _text("l_extendedprice").alias("payment_value"),
        )

    def raw_order_reviews(self) -> DataFrame:
        return self.read("events").select(
            _text("event_id").alias("review_id"),
            (F.col("event_id") + F.col("event_id") % 2).cast("string").alias("order_id"),
            _score().cast("string").alias("review_score"),
            F.concat(F.lit(" "), "event_type").alias("review_comment_title"),
            F.lit("  ").alias("review_comment_message"),
            _text("ts").alias("review_creation_date"),
            F.lit("not a time").alias("review_answer_timestamp"),
        )

    def raw_products(self) -> DataFrame:
        return self.read("part").select(
            _text("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_category_name"),
            F.lit("1").alias("product_name_lenght"),
            F.lit("1").alias("product_description_lenght"),
            _text("p_size").alias("product_photos_qty"),
            _text("p_retailprice").alias("product_weight_g"),
            _text("p_size").alias("product_length_cm"),
            F.lit("").alias("product_height_cm"),
            F.lit("wide").alias("product_width_cm"),
        )

    def raw_translation(self) -> DataFrame:
        """Every part type but one, in lower case."""
        kinds = self.read("part").select("p_type").distinct().filter(F.col("p_type") != "PROMO")
        return kinds.select(
            F.col("p_type").alias("product_category_name"),
            F.lower("p_type").alias("product_category_name_english"),
        )

    def raw_sellers(self) -> DataFrame:
        return (
            self.read("supplier")
            .join(self._nations(), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                _text("s_suppkey").alias("seller_id"),
                _text("s_nationkey").alias("seller_zip_code_prefix"),
                F.col("s_name").alias("seller_city"),
                F.lower("n_name").alias("seller_state"),
            )
        )


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _person() -> Column:
    """Three consecutive orders belong to one person."""
    return F.concat(F.lit("u"), (F.col("o_orderkey") - F.col("o_orderkey") % 3).cast("string"))


def _score() -> Column:
    return (F.lit(1) + F.floor("value").cast("int") % 5).cast("int")
