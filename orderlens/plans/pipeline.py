"""Ingest, build, validate, export: the stages, each committed as a whole."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from orderlens.operators.hot_join import hot_keys
from orderlens.plans.context import resolve_context
from orderlens.plans.lines import delivered_lines
from orderlens.plans.model import build_model
from orderlens.plans.orders import delivery_experience, executive_monthly, order_summary
from orderlens.plans.performance import category_performance, seller_performance
from orderlens.plans.publication import EXPORT_TABLES, public_rows
from orderlens.plans.quality import GateResult, PublicationBlocked, check_listing, gate, quality_checks, quality_summary
from orderlens.plans.segmentation import (
    customer_base,
    customer_category_affinity,
    customer_cross_segment,
    customer_segment_summary,
    customer_segmentation,
)
from orderlens.session import release
from orderlens.sources.landing import landing_manifest, read_landing, require_contract, snapshot_manifest
from orderlens.sources.published import write_csv
from orderlens.sources.warehouse import Warehouse

# Written by the build because several marts read them; not part of the delivered model.
INTERMEDIATE = ("delivered_lines", "customer_base")
# Tables that are joined on the order, stored in buckets of it where the warehouse has buckets. Those that
# are made from others of them are dealt to the buckets already.
BUCKET_KEY = "order_id"
BUCKETED = ("fct_order", "fct_order_item", "fct_payment", "fct_review", "order_summary", "delivered_lines")
DEALT = ("order_summary", "delivered_lines")
ROWS_PER_BUCKET = 500_000
"""Rows of a fact that a bucket holds on average at most; one task reads and joins a bucket."""
# Tables written at the same time; each write is a distributed job of its own.
CONCURRENT_WRITES = 6


@dataclass(frozen=True)
class IngestResult:
    ingest_run_id: str
    tables: int
    rows: int


@dataclass(frozen=True)
class BuildResult:
    build_id: str
    as_of_date: date
    tables_built: int


@dataclass(frozen=True)
class ExportResult:
    build_id: str
    as_of_date: str
    exported_tables: int
    exported_rows: int
    path: str


def _write_together(
    warehouse: Warehouse, kind: str, run_id: str, frames: Mapping[str, DataFrame], buckets: int = 0
) -> list[tuple[str, DataFrame, int]]:
    """Write independent tables as concurrent jobs: name, stored table and rows of each. The first
    failure is raised once the others have ended, and nothing is committed. What they shuffled is let go."""

    def write(name: str) -> tuple[str, DataFrame, int]:
        key = BUCKET_KEY if buckets and name in BUCKETED else None
        return name, *warehouse.write(kind, run_id, name, frames[name], key, buckets, dealt=name in DEALT)

    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        written = list(pool.map(inheritable_thread_target(warehouse.spark)(write), frames))
    release(warehouse.spark)
    return written


def ingest(
    warehouse: Warehouse, source_dir: str, force: bool = False, multi_line: bool | None = None
) -> IngestResult:
    """Load the landing files as text. A committed ingest is returned as it is unless forced; one that was
    overtaken by another is refused.

    Files of free text may hold line breaks inside quotes. ``multi_line`` allows them in every file, not
    only in those; a file that is read so is one task, so it should land in many parts.
    """
    done = warehouse.current("ingest")
    if done is not None and not force:
        return IngestResult(done["run_id"], len(done["tables"]), done["row_count"])
    require_contract(warehouse.spark, source_dir)
    run_id = str(uuid.uuid4())
    landed = read_landing(warehouse.spark, source_dir, multi_line)
    counts = {name: rows for name, _, rows in _write_together(warehouse, "ingest", run_id, landed)}
    warehouse.commit("ingest", run_id, counts, based_on=0 if done is None else done["version"])
    return IngestResult(run_id, len(counts), sum(counts.values()))


def record_landing(warehouse: Warehouse, source_dir: str, dataset: str, source: str) -> DataFrame:
    """Store the manifest of the landing files: one JSON line per file, and the snapshot as one line."""
    spark, run_id = warehouse.spark, str(uuid.uuid4())
    files_path = warehouse.path("landing", run_id, "files")
    landing_manifest(spark, source_dir, "*.csv").write.json(files_path)
    files = spark.read.schema("file string, path string, bytes bigint, sha256 string").json(files_path)
    snapshot = snapshot_manifest(files, dataset, source)
    snapshot.write.json(warehouse.path("landing", run_id, "snapshot"))
    warehouse.commit("landing", run_id, {"files": files.count(), "snapshot": 1})
    return files


def _buckets(warehouse: Warehouse, raw: Mapping[str, DataFrame]) -> int:
    """Into how many buckets this run's tables go: the warehouse's number, or as many times that as keep a
    bucket's rows few however large the facts are. A bucket is read by one task, so if some order holds
    more than a bucket's share of a fact, the tables are stored plainly and joins split it."""
    if not warehouse.buckets:
        return 0
    facts = [raw[name] for name in ("raw_order_items", "raw_order_payments", "raw_order_reviews")]
    rows = max(fact.count() for fact in facts)
    buckets = warehouse.buckets * max(1, -(-rows // (warehouse.buckets * ROWS_PER_BUCKET)))
    return 0 if any(hot_keys(fact, BUCKET_KEY, buckets) for fact in facts) else buckets


def build(warehouse: Warehouse, as_of: date | None = None) -> BuildResult:
    """Typed model, marts and checks of the current ingest, committed together. A build that was overtaken
    by another is refused.

    Each table is written once and read back by the tables after it, so the order summary and the
    delivered lines are joined once however many marts use them.
    """
    based_on = warehouse.version("build")
    source = warehouse.current("ingest")
    if source is None:
        raise FileNotFoundError("No existe el warehouse. Ejecute primero ingest.")
    raw = warehouse.tables("ingest", source)
    ctx = resolve_context(raw["raw_orders"], as_of)
    buckets = _buckets(warehouse, raw)
    built: dict[str, DataFrame] = {}
    counts: dict[str, int] = {}

    def store(**frames: DataFrame) -> None:
        """Write tables that do not read each other, side by side."""
        for name, stored, rows in _write_together(warehouse, "build", ctx.build_id, frames, buckets):
            built[name], counts[name] = stored, rows

    store(build_context=ctx.frame(warehouse.spark), **build_model(raw))
    items, products = built["fct_order_item"], built["dim_product"]

    facts = (items, built["fct_payment"], built["fct_review"])
    lie = {"stored_by_order": True} if buckets else {}
    store(order_summary=order_summary(built["fct_order"], *facts, **lie))
    summary = built["order_summary"]
    store(delivered_lines=delivered_lines(summary, items, ctx))
    lines = built["delivered_lines"]
    store(customer_base=customer_base(lines, products))
    store(customer_segmentation=customer_segmentation(built["customer_base"], ctx))
    segments = built["customer_segmentation"]
    store(
        executive_monthly=executive_monthly(summary, ctx),
        delivery_experience=delivery_experience(summary, ctx),
        customer_segment_summary=customer_segment_summary(segments, ctx),
        customer_cross_segment=customer_cross_segment(segments, ctx),
        customer_category_affinity=customer_category_affinity(lines, products, segments, ctx),
        category_performance=category_performance(lines, products, ctx),
        seller_performance=seller_performance(lines, built["dim_seller"], ctx),
        quality_checks=quality_checks(built, ctx),
    )
    warehouse.commit(
        "build",
        ctx.build_id,
        counts,
        parent_id=source["run_id"],
        as_of=ctx.as_of,
        bucketed=dict.fromkeys(BUCKETED, BUCKET_KEY) if buckets else None,
        buckets=buckets,
        based_on=based_on,
    )
    return BuildResult(ctx.build_id, ctx.as_of, table_count(warehouse))


def table_count(warehouse: Warehouse) -> int:
    """Tables of the current ingest and build, the ingest state included."""
    ingested, current = warehouse.current("ingest"), warehouse.current("build")
    delivered = [] if current is None else [t for t in current["tables"] if t not in INTERMEDIATE]
    return 0 if ingested is None else len(ingested["tables"]) + 1 + len(delivered)


def _current_build(warehouse: Warehouse) -> Row:
    run = warehouse.current("build")
    if run is None:
        raise FileNotFoundError("No existe el warehouse. Ejecute primero ingest y build.")
    return run


def validate(
    warehouse: Warehouse, report_dir: str, raise_on_failure: bool = True, run: Row | None = None
) -> GateResult:
    """Write the gate summary and the check listing of a build, then apply the gate to it.

    ``run`` is a build looked up before; by default the current one.
    """
    checks = warehouse.tables("build", run or _current_build(warehouse))["quality_checks"]
    result = gate(checks, raise_on_failure=False)
    report = f"{report_dir}/{result.as_of_date}/{uuid.uuid4()}"
    quality_summary(checks).write.json(f"{report}/summary")
    write_csv(check_listing(checks), f"{report}/checks")
    if result.high_failures and raise_on_failure:
        raise PublicationBlocked(
            f"El build tiene {result.high_failures} controles HIGH fallidos. Ver {report}"
        )
    return result


def _write_exports(tables: Mapping[str, DataFrame], out: str) -> None:
    def write(name: str) -> None:
        write_csv(tables[name], f"{out}/internal/csv/{name}")
        tables[name].write.parquet(f"{out}/internal/parquet/{name}")
        write_csv(tables[name], f"{out}/internal/spreadsheet/{name}", spreadsheet=True)
        write_csv(public_rows(tables[name]), f"{out}/public/{name}")

    spark = next(iter(tables.values())).sparkSession
    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), EXPORT_TABLES))


def export(warehouse: Warehouse, out_dir: str) -> ExportResult:
    """Publish the current build, through the gate only. The build is looked up once, so what passes
    the gate is what is published, whatever is committed meanwhile. The manifest is written last: a
    folder without one is unfinished."""
    run = _current_build(warehouse)
    validation = validate(warehouse, f"{out_dir}/reports", run=run)
    tables = warehouse.tables("build", run)
    export_id = str(uuid.uuid4())
    out = f"{out_dir}/export_id={export_id}"
    _write_exports(tables, out)
    counts = {name: warehouse.spark.read.parquet(f"{out}/internal/parquet/{name}").count() for name in EXPORT_TABLES}
    manifest = warehouse.spark.range(1).select(
        *[F.lit(value).alias(name) for name, value in asdict(validation).items()],
        F.current_timestamp().alias("exported_at"),
        F.struct(*[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()]).alias("rows"),
    )
    manifest.coalesce(1).write.json(f"{out}/manifest")
    warehouse.commit("export", export_id, counts, parent_id=validation.build_id, as_of=date.fromisoformat(validation.as_of_date))
    return ExportResult(validation.build_id, validation.as_of_date, len(counts), sum(counts.values()), out)


def run_all(
    spark: SparkSession, root: str, source_dir: str, out_dir: str, as_of: date | None = None, force: bool = False
) -> ExportResult:
    """Every stage in order."""
    warehouse = Warehouse(spark, root)
    ingest(warehouse, source_dir, force)
    build(warehouse, as_of)
    return export(warehouse, out_dir)
