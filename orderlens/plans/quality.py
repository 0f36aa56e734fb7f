"""Fifteen data-quality checks and the gate that can block publication.

The checks of keys, unique ones and orphans alike, are one union and one aggregate over all tables; the
other checks of a table are one aggregate of it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.contracts import FAILED_STATUSES
from orderlens.operators.keys import Keyed, key_totals
from orderlens.plans.context import BuildContext
from orderlens.plans.lines import eligible_lines
from orderlens.plans.orders import invalid_chronology, is_delivered


@dataclass(frozen=True)
class Check:
    severity: str
    threshold: float
    details: str


# Ids, severities, thresholds and texts of the published check table.
CHECKS = {
    "orders_pk_unique": Check("HIGH", 0.0, "order_id debe ser unico en fct_order"),
    "customers_bridge_pk_unique": Check("HIGH", 0.0, "customer_id debe ser unico en el puente pedido-cliente"),
    "order_items_pk_unique": Check("HIGH", 0.0, "order_id + order_item_id debe ser unico"),
    "orders_without_customer": Check("HIGH", 0.0, "Todo pedido debe resolver customer_unique_id"),
    "items_without_order": Check("HIGH", 0.0, "Todo item debe resolver un pedido"),
    "items_without_product": Check("HIGH", 0.0, "Todo item debe resolver un producto"),
    "items_without_seller": Check("HIGH", 0.0, "Todo item debe resolver un vendedor"),
    "negative_item_values": Check("HIGH", 0.0, "Los importes de item no pueden ser negativos"),
    "invalid_order_chronology_source": Check(
        "MEDIUM", 0.0, "Filas excluidas de metricas operativas; el dato fuente no se corrige"
    ),
    "customer_segment_unique": Check("HIGH", 0.0, "Cada cliente elegible debe tener una sola segmentacion"),
    "customer_segment_complete": Check("HIGH", 0.0, "Las tres dimensiones de segmentacion son obligatorias"),
    "customer_gmv_reconciliation": Check("HIGH", 0.01, "El GMV segmentado debe reconciliar con items elegibles"),
    "unknown_product_categories": Check("MEDIUM", 0.0, "Categorias sin traduccion o clasificacion"),
    "orders_payment_difference_gt_1": Check(
        "MEDIUM", 0.0, "Diferencias pueden incluir vouchers y ajustes; se informan, no se imputan"
    ),
    "orders_without_review": Check("MEDIUM", 0.0, "Pedidos entregados sin review"),
}


def orphan_rows(items: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Keys of ``items`` that ``parents`` does not have, a NULL key included, with their rows."""
    return items.groupBy(key).agg(F.count("*").alias("rows")).join(parents.select(key), key, "left_anti")


def payment_gap() -> Column:
    """Orders, not failed, whose payments differ by more than one from value plus freight."""
    gap = F.abs(F.col("paid_value_brl") - F.col("merchandise_gmv_brl") - F.col("freight_value_brl"))
    return (gap > 1) & ~F.col("order_status").isin(*FAILED_STATUSES)


def _observe(table: DataFrame, **checks: Column) -> DataFrame:
    """All checks of a table in one aggregate, as rows (check_id, observed_value)."""
    row = table.agg(*[observed.cast("double").alias(name) for name, observed in checks.items()])
    return row.unpivot([], list(checks), "check_id", "observed_value")


# Of each kind of key the check of its defining rows, and that of the rows that refer to it.
_KEY_CHECKS = {
    "order": ("orders_pk_unique", "items_without_order"),
    "address": ("customers_bridge_pk_unique", None),
    "item": ("order_items_pk_unique", None),
    "product": (None, "items_without_product"),
    "seller": (None, "items_without_seller"),
    "person": ("customer_segment_unique", None),
}


def _key_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    items = tables["fct_order_item"]
    totals = key_totals(
        [
            Keyed("order", tables["fct_order"], ["order_id"]),
            Keyed("order", items, ["order_id"], refers=True),
            Keyed("address", tables["bridge_customer_order_address"], ["customer_id"]),
            Keyed("item", items, ["order_id", "order_item_id"]),
            Keyed("product", tables["dim_product"], ["product_id"]),
            Keyed("product", items, ["product_id"], refers=True),
            Keyed("seller", tables["dim_seller"], ["seller_id"]),
            Keyed("seller", items, ["seller_id"], refers=True),
            Keyed("person", tables["customer_segmentation"], ["customer_unique_id"]),
        ]
    )
    found = {}
    for kind, checks in _KEY_CHECKS.items():
        for check_id, measure in zip(checks, ("surplus", "orphans")):
            if check_id:
                found[check_id] = F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(measure))), F.lit(0))
    return _observe(totals, **found)


def _reconciliation(segmentation: DataFrame, lines: DataFrame) -> DataFrame:
    """Segmented value against eligible line value; NULL, hence a failure, when either is missing."""
    segmented = segmentation.agg(F.sum("merchandise_gmv_brl").cast("decimal(38,2)").alias("segmented"))
    eligible = eligible_lines(lines).agg(F.sum("item_value_brl").cast("decimal(38,2)").alias("eligible"))
    both = segmented.unionByName(eligible, allowMissingColumns=True)
    gap = F.abs(F.max("segmented") - F.max("eligible"))
    return _observe(both, customer_gmv_reconciliation=gap)


def observations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(check_id, observed_value) for every check.

    ``tables``: fct_order, bridge_customer_order_address, fct_order_item, dim_product, dim_seller,
    order_summary, customer_segmentation and delivered_lines.
    """
    orders, items = tables["fct_order"], tables["fct_order_item"]
    segmentation, summary = tables["customer_segmentation"], tables["order_summary"]
    unlabelled = F.col("value_segment").isNull() | F.col("unit_segment").isNull() | F.col("category_segment").isNull()
    parts = [
        _observe(
            orders,
            orders_without_customer=F.count_if(F.col("customer_unique_id").isNull()),
            invalid_order_chronology_source=F.count_if(invalid_chronology()),
        ),
        _key_checks(tables),
        _observe(items, negative_item_values=F.count_if(F.col("item_value_brl") < 0)),
        _observe(segmentation, customer_segment_complete=F.count_if(unlabelled)),
        _reconciliation(segmentation, tables["delivered_lines"]),
        _observe(
            tables["dim_product"],
            unknown_product_categories=F.count_if(F.col("category_name") == "unknown"),
        ),
        _observe(
            summary,
            orders_payment_difference_gt_1=F.count_if(payment_gap()),
            orders_without_review=F.count_if(is_delivered() & (F.col("review_rows") == 0)),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def quality_checks(tables: Mapping[str, DataFrame], ctx: BuildContext) -> DataFrame:
    """The check table. A check that could not be observed fails."""
    found = observations(tables)
    rules = F.create_map(
        *[
            part
            for check_id, c in CHECKS.items()
            for part in (
                F.lit(check_id),
                F.struct(
                    F.lit(c.severity).alias("severity"),
                    F.lit(c.threshold).alias("threshold"),
                    F.lit(c.details).alias("details"),
                ),
            )
        ]
    )
    rule = F.element_at(rules, F.col("check_id"))
    passed = F.col("observed_value") <= rule["threshold"]
    return found.select(
        *ctx.tags(),
        "check_id",
        rule["severity"].alias("severity"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        "observed_value",
        rule["threshold"].alias("threshold"),
        rule["details"].alias("details"),
    )


def quality_summary(checks: DataFrame) -> DataFrame:
    """One row: checks run, HIGH failures, MEDIUM warnings, and whether the build may be published."""
    failed = F.col("status") == "FAIL"
    return checks.agg(
        F.max("build_id").alias("build_id"),
        F.max("as_of_date").alias("as_of_date"),
        F.count("*").alias("checks"),
        F.count_if(failed & (F.col("severity") == "HIGH")).alias("high_failures"),
        F.count_if(failed & (F.col("severity") == "MEDIUM")).alias("medium_warnings"),
    ).withColumn("publishable", (F.col("checks") > 0) & (F.col("high_failures") == 0))


def check_listing(checks: DataFrame) -> DataFrame:
    return checks.orderBy("severity", "check_id")


@dataclass(frozen=True)
class GateResult:
    build_id: str
    as_of_date: str
    checks: int
    high_failures: int
    medium_warnings: int


class PublicationBlocked(RuntimeError):
    """A HIGH check failed."""


def gate(checks: DataFrame, raise_on_failure: bool = True) -> GateResult:
    """Read the stored checks; refuse an empty table, and a HIGH failure unless told otherwise."""
    row = quality_summary(checks).first()
    if row["checks"] == 0:
        raise ValueError("El build no contiene controles de calidad.")
    result = GateResult(
        row["build_id"], str(row["as_of_date"]), row["checks"], row["high_failures"], row["medium_warnings"]
    )
    if result.high_failures and raise_on_failure:
        raise PublicationBlocked(f"El build tiene {result.high_failures} controles HIGH fallidos.")
    return result
