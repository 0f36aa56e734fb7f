"""The build: its id, cut date and versions, put on every published row as literals."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.contracts import SCHEMA_VERSION, SEGMENTATION_VERSION
from orderlens.functions.parsing import parse_timestamp


@dataclass(frozen=True)
class BuildContext:
    as_of: date
    build_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    schema_version: str = SCHEMA_VERSION
    segmentation_version: str = SEGMENTATION_VERSION

    def tags(self, versioned: bool = False) -> list[Column]:
        tags = [F.lit(self.build_id).alias("build_id"), F.lit(self.as_of).alias("as_of_date")]
        if versioned:
            tags.append(F.lit(self.segmentation_version).alias("segmentation_version"))
        return tags

    def frame(self, spark: SparkSession) -> DataFrame:
        """The build as a one-row table."""
        return spark.range(1).select(
            F.lit(self.build_id).alias("build_id"),
            F.lit(self.as_of).alias("as_of_date"),
            F.lit(self.schema_version).alias("schema_version"),
            F.lit(self.segmentation_version).alias("segmentation_version"),
            F.current_timestamp().alias("built_at"),
        )


def last_purchase_date(raw_orders: DataFrame) -> date | None:
    """Latest purchase day that parses: one value, the default cut date."""
    purchased = parse_timestamp(F.col("order_purchase_timestamp")).cast("date")
    return raw_orders.agg(F.max(purchased).alias("day")).first()["day"]


def resolve_context(raw_orders: DataFrame, as_of: date | None = None) -> BuildContext:
    effective = as_of or last_purchase_date(raw_orders)
    if effective is None:
        raise ValueError("No se pudo determinar la fecha de corte.")
    return BuildContext(effective)
