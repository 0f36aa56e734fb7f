"""What leaves the warehouse: public views and the datasets behind the published figures."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.display import currency, month_label, two_decimals, whole_number
from orderlens.functions.labels import (
    CATEGORY_LABELS,
    DELIVERY_STATUS_LABELS,
    DIMENSION_LABELS,
    SEGMENT_LABELS,
    label,
    unmapped,
)
from orderlens.functions.measures import finite, weighted_mean

# The published tables, in publication order. Order and person grain never leave.
EXPORT_TABLES = (
    "executive_monthly",
    "customer_segment_summary",
    "customer_cross_segment",
    "customer_category_affinity",
    "category_performance",
    "seller_performance",
    "delivery_experience",
    "quality_checks",
)

# Tables and columns the dashboard datasets need.
DASHBOARD_COLUMNS = {
    "executive_monthly": ("month_start", "as_of_date", "merchandise_gmv_brl", "delivered_orders", "units"),
    "customer_segment_summary": ("segment_dimension", "segment_label", "customers", "merchandise_gmv_brl"),
    "category_performance": ("category_name", "merchandise_gmv_brl", "orders", "coverage_status"),
    "delivery_experience": ("delivery_status", "orders", "avg_review_score", "reviewed_orders", "coverage_status"),
}

TOP_CATEGORIES = 12


def public_rows(frame: DataFrame) -> DataFrame:
    """Rows marked PUBLISHABLE; a table without a coverage column is public as a whole."""
    if "coverage_status" not in frame.columns:
        return frame
    return frame.filter(F.col("coverage_status") == "PUBLISHABLE")


def public_tables(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: public_rows(tables[name]) for name in EXPORT_TABLES}


def require_dashboard_columns(tables: Mapping[str, DataFrame]) -> None:
    for name, columns in DASHBOARD_COLUMNS.items():
        if name not in tables:
            raise ValueError(f"Falta la tabla requerida del dashboard: {name}")
        missing = sorted(set(columns) - set(tables[name].columns))
        if missing:
            raise ValueError(f"Faltan columnas en {name}: {', '.join(missing)}")


def require_labels(tables: Mapping[str, DataFrame], categories: Mapping[str, str] = CATEGORY_LABELS) -> None:
    """Every published code has a label. The error names all codes that have none."""
    published = (
        ("customer_segment_summary", "segment_dimension", DIMENSION_LABELS, "dimensiones de segmento"),
        ("customer_segment_summary", "segment_label", SEGMENT_LABELS, "segmentos"),
        ("category_performance", "category_name", categories, "categorías"),
        ("delivery_experience", "delivery_status", DELIVERY_STATUS_LABELS, "estados de entrega"),
    )
    for name, code, labels, kind in published:
        missing = [row[code] for row in unmapped(public_rows(tables[name]), code, labels).orderBy(code).toLocalIterator()]
        if missing:
            raise ValueError(f"Faltan traducciones de {kind}: {', '.join(missing)}")


def _one_row(parts: list[DataFrame]) -> DataFrame:
    """One-row frames side by side, without a join: stacked, then the only value of each column."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def top_category(categories: DataFrame, count: int = 1) -> DataFrame:
    """Publishable categories with the highest value; the name decides between equals."""
    ranked = public_rows(categories).withColumn("merchandise_gmv_brl", finite(F.col("merchandise_gmv_brl")))
    return ranked.orderBy(F.desc_nulls_last("merchandise_gmv_brl"), "category_name").limit(count)


def executive_facts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The figures of the executive summary in one row. Scores are NULL without coverage."""
    value = tables["customer_segment_summary"].filter(F.col("segment_dimension") == "VALUE")
    is_a = F.col("segment_label") == "A_HIGH_VALUE"
    score, reviewed = F.col("avg_review_score"), F.col("reviewed_orders")
    status = F.col("delivery_status")
    return _one_row(
        [
            tables["executive_monthly"].agg(F.sum("merchandise_gmv_brl").alias("total_gmv_brl")),
            value.agg(
                F.sum("customers").alias("customers"),
                F.max(F.when(is_a, F.col("customers"))).alias("segment_a_customers"),
                F.max(F.when(is_a, F.col("gmv_share"))).alias("segment_a_gmv_share"),
            ),
            top_category(tables["category_performance"]).select(
                F.col("category_name").alias("top_category"),
                F.col("merchandise_gmv_brl").alias("top_category_gmv_brl"),
            ),
            public_rows(tables["delivery_experience"]).agg(
                weighted_mean(score, reviewed, status == "ON_TIME").alias("on_time_review_score"),
                weighted_mean(score, reviewed, status == "LATE").alias("late_review_score"),
            ),
        ]
    )


def headline_kpis(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Totals over finite values, and the cut date. Customers are counted in one dimension only."""
    monthly, segments = tables["executive_monthly"], tables["customer_segment_summary"]
    in_value = F.col("segment_dimension") == "VALUE"
    return _one_row(
        [
            monthly.agg(
                F.sum(finite(F.col("merchandise_gmv_brl"))).alias("total_gmv_brl"),
                F.sum(finite(F.col("delivered_orders"))).alias("delivered_orders"),
                F.sum(finite(F.col("units"))).alias("units"),
                F.max("as_of_date").alias("as_of_date"),
            ),
            segments.agg(F.sum(finite(F.when(in_value, F.col("customers")))).alias("customers")),
        ]
    )


def monthly_series(executive_monthly: DataFrame) -> DataFrame:
    value = finite(F.col("merchandise_gmv_brl"))
    return executive_monthly.select(
        "month_start",
        month_label(F.col("month_start")).alias("month_label"),
        value.alias("merchandise_gmv_brl"),
        currency(value).alias("gmv_text"),
    ).orderBy("month_start")


def value_segments(segment_summary: DataFrame) -> DataFrame:
    """The value dimension, smallest value first."""
    value = finite(F.col("merchandise_gmv_brl"))
    return (
        segment_summary.filter(F.col("segment_dimension") == "VALUE")
        .select(
            "segment_label",
            label(F.col("segment_label"), SEGMENT_LABELS, "segmentos").alias("segment_name"),
            value.alias("merchandise_gmv_brl"),
            "customers",
            currency(value).alias("gmv_text"),
            whole_number(F.col("customers")).alias("customers_text"),
        )
        .orderBy("merchandise_gmv_brl", "segment_label")
    )


def top_categories(categories: DataFrame, labels: Mapping[str, str] = CATEGORY_LABELS) -> DataFrame:
    """The twelve publishable categories of highest value, shown smallest first."""
    value = F.col("merchandise_gmv_brl")
    return (
        top_category(categories, TOP_CATEGORIES)
        .select(
            "category_name",
            label(F.col("category_name"), labels, "categorías").alias("category_label"),
            value,
            "orders",
            currency(value).alias("gmv_text"),
            whole_number(F.col("orders")).alias("orders_text"),
        )
        .orderBy(F.asc_nulls_last("merchandise_gmv_brl"), "category_name")
    )


def delivery_summary(delivery: DataFrame) -> DataFrame:
    """Publishable delivery strata by status. A stratum whose score or weight is not usable keeps its
    orders and weighs nothing; a status without weight has no score."""
    score, weight = finite(F.col("avg_review_score")), finite(F.col("reviewed_orders"))
    usable = score.isNotNull() & (weight > 0)
    weight = F.when(usable, weight).otherwise(0)
    return (
        public_rows(delivery)
        .groupBy("delivery_status")
        .agg(
            F.sum("orders").alias("orders"),
            F.sum(weight).alias("reviewed_orders"),
            weighted_mean(F.when(usable, score).otherwise(0), weight).alias("avg_review_score"),
        )
        .select(
            "delivery_status",
            label(F.col("delivery_status"), DELIVERY_STATUS_LABELS, "estados de entrega").alias("status_label"),
            "orders",
            "reviewed_orders",
            "avg_review_score",
            two_decimals(F.col("avg_review_score")).alias("score_text"),
            whole_number(F.col("orders")).alias("orders_text"),
        )
        .orderBy(F.desc("orders"), "delivery_status")
    )
