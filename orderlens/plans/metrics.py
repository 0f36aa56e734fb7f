"""The measures of the report model: thirty named aggregates over the published marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.measures import ratio

def _sum(column: str, where: Column | None = None) -> Column:
    return F.sum(column if where is None else F.when(where, F.col(column)))


def _weighted(value: str, weight: str, where: Column | None = None) -> Column:
    """Sum of value x weight over all weights: a NULL value adds nothing and keeps its weight."""
    kept = F.col(weight) if where is None else F.when(where, F.col(weight))
    return ratio(F.sum(F.col(value) * kept), F.sum(kept))


@dataclass(frozen=True)
class Measure:
    table: str
    value: Column


def measures() -> dict[str, Measure]:
    """All measures of a single mart. Names are fixed values, as the report model names them."""
    public = F.col("coverage_status") == "PUBLISHABLE"
    in_value = (F.col("segment_dimension") == "VALUE") & public
    in_categories = (F.col("segment_dimension") == "CATEGORIES") & public
    high_value = in_value & (F.col("segment_label") == "A_HIGH_VALUE")
    late = public & (F.col("delivery_status") == "LATE")
    on_time = public & (F.col("delivery_status") == "ON_TIME")
    failed = F.col("status") == "FAIL"
    return {
        "Pedidos": Measure("executive_monthly", _sum("orders")),
        "Pedidos entregados": Measure("executive_monthly", _sum("delivered_orders")),
        "GMV": Measure("executive_monthly", _sum("merchandise_gmv_brl")),
        "Ticket promedio": Measure("executive_monthly", ratio(_sum("merchandise_gmv_brl"), _sum("delivered_orders"))),
        "Tasa de pedidos fallidos": Measure("executive_monthly", ratio(_sum("failed_orders"), _sum("orders"))),
        "Tasa de entrega tardia": Measure("executive_monthly", _weighted("late_delivery_rate", "delivered_orders")),
        "Clientes elegibles": Measure("customer_segment_summary", _sum("customers", in_value)),
        "Clientes alto valor": Measure("customer_segment_summary", _sum("customers", high_value)),
        "Share GMV alto valor": Measure(
            "customer_segment_summary",
            ratio(_sum("merchandise_gmv_brl", high_value), _sum("merchandise_gmv_brl", in_value)),
        ),
        "Clientes una categoria": Measure(
            "customer_segment_summary",
            _sum("customers", in_categories & (F.col("segment_label") == "SPECIALIST")),
        ),
        "GMV por segmento": Measure("customer_segment_summary", _sum("merchandise_gmv_brl", in_value)),
        "Clientes cruce": Measure("customer_cross_segment", _sum("customers", public)),
        "GMV afinidad": Measure("customer_category_affinity", _sum("merchandise_gmv_brl", public)),
        "GMV categorias": Measure("category_performance", _sum("merchandise_gmv_brl", public)),
        "Review categoria": Measure("category_performance", F.avg(F.when(public, F.col("avg_review_score")))),
        "Ordenes entrega": Measure("delivery_experience", _sum("orders", public)),
        "Ordenes tardias": Measure("delivery_experience", _sum("orders", late)),
        "Tasa tardia publicable": Measure("delivery_experience", ratio(_sum("orders", late), _sum("orders", public))),
        "Review ponderada": Measure("delivery_experience", _weighted("avg_review_score", "reviewed_orders", public)),
        "Review a tiempo": Measure("delivery_experience", _weighted("avg_review_score", "reviewed_orders", on_time)),
        "Review tardia": Measure("delivery_experience", _weighted("avg_review_score", "reviewed_orders", late)),
        "Vendedores publicables": Measure("seller_performance", F.countDistinct(F.when(public, F.col("seller_id")))),
        "GMV vendedores": Measure("seller_performance", _sum("merchandise_gmv_brl", public)),
        "Tasa tardia vendedores": Measure("seller_performance", _weighted("late_delivery_rate", "orders", public)),
        "Controles": Measure("quality_checks", F.count("*")),
        "Fallas altas": Measure("quality_checks", F.count_if(failed & (F.col("severity") == "HIGH"))),
        "Advertencias medias": Measure("quality_checks", F.count_if(failed & (F.col("severity") == "MEDIUM"))),
        "Tasa controles aprobados": Measure("quality_checks", ratio(F.count_if(F.col("status") == "PASS"), F.count("*"))),
        "Valor observado fallas": Measure("quality_checks", _sum("observed_value", failed)),
    }


# The thirtieth measure spans several marts.
SUPPRESSED_ROWS = "Filas suprimidas"
COVERED_TABLES = (
    "customer_segment_summary",
    "customer_cross_segment",
    "customer_category_affinity",
    "category_performance",
    "delivery_experience",
    "seller_performance",
)


def evaluate(
    tables: Mapping[str, DataFrame], names: Sequence[str], by: Sequence[str] = (), ranked: bool = False
) -> DataFrame:
    """Measures of one mart in one aggregate, per group of ``by`` or as a single row.

    ``ranked`` sorts as the charts do: by the first measure, greatest first, then by the groups.
    """
    known = measures()
    sources = {known[name].table for name in names}
    if len(sources) != 1:
        raise ValueError(f"measures of one mart at a time, not of {sorted(sources)}")
    values = [known[name].value.alias(name) for name in names]
    measured = tables[sources.pop()].groupBy(*by).agg(*values)
    return measured.orderBy(F.desc_nulls_last(f"`{names[0]}`"), *by) if ranked else measured


def suppressed_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of the covered marts below the coverage threshold; zero on public data."""
    present = [tables[name].select("coverage_status") for name in COVERED_TABLES if name in tables]
    stacked = reduce(DataFrame.unionAll, present)
    return stacked.agg(F.count_if(F.col("coverage_status") == "SUPPRESSED").alias(SUPPRESSED_ROWS))


# The date each published table is related to the calendar by.
CALENDAR_DATES = {
    "executive_monthly": "month_start",
    "delivery_experience": "month_start",
    "customer_segment_summary": "as_of_date",
    "customer_cross_segment": "as_of_date",
    "customer_category_affinity": "as_of_date",
    "category_performance": "as_of_date",
    "seller_performance": "as_of_date",
    "quality_checks": "as_of_date",
}


def with_calendar(table: DataFrame, name: str, calendar: DataFrame) -> DataFrame:
    """A published table with the calendar columns of its date, for measures by year or month."""
    return table.join(calendar, table[CALENDAR_DATES[name]] == calendar["Fecha"], "left")
