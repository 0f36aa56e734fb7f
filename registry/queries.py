"""Every operator over the whole sample tables, as (spark, sf_dir) -> DataFrame.

A result that several steps of one query read is materialized once, as the build does. Averages
of averages are rounded to nine places, because the order of a floating-point sum is not fixed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.contracts import RAW_TABLES, RawTable
from orderlens.functions import display
from orderlens.functions.labels import CATEGORY_LABELS, label_or_null, unmapped
from orderlens.functions.parsing import blank_to_null, parse_decimal, parse_double, parse_int, parse_timestamp
from orderlens.operators.abc import abc_class, bucket_cumulative, value_buckets
from orderlens.operators.group_stats import group_median, group_mode
from orderlens.operators.keys import nested_surplus
from orderlens.operators.prefix_sum import prefix_sum
from orderlens.plans import lines as lines_plan
from orderlens.plans import metrics, model, orders, performance, publication, quality, segmentation
from orderlens.plans.context import BuildContext, last_purchase_date
from orderlens.plans.pipeline import CONCURRENT_WRITES, build, export, ingest, table_count, validate
from orderlens.plans.quality import PublicationBlocked
from orderlens.session import materialize, materialize_together, scratch_dir
from orderlens.sources.commits import ConcurrentRun
from orderlens.sources.landing import landing_manifest, snapshot_manifest
from orderlens.sources.published import check_all_published, check_published, read_published, write_csv
from orderlens.sources.sample import Sample
from orderlens.sources.warehouse import Warehouse

CONTEXT = BuildContext(date(1997, 12, 31), build_id="build-0")
EARLY = BuildContext(date(1995, 12, 31), build_id="build-0")

# Labels of the sample's part types.
PART_LABELS = {
    "economy": "Económico",
    "standard": "Estándar",
    "small": "Pequeño",
    "medium": "Mediano",
    "large": "Grande",
    "unknown": "Sin categoría informada",
}


class Canonical:
    """Frames of one query over the sample, each built on first use and at most once."""

    def __init__(self, spark: SparkSession, sf_dir: str, ctx: BuildContext = CONTEXT):
        self.spark, self.ctx = spark, ctx
        self.sample = Sample(spark, sf_dir)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = getattr(self, f"_{name}")()
        return self._built[name]

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {name: self[name] for name in names}

    def _order_summary(self):
        s = self.sample
        return orders.order_summary(s.person_orders(), s.items(), s.payments(), s.reviews())

    def _delivered_lines(self):
        return lines_plan.delivered_lines(self["order_summary"], self.sample.items(), self.ctx)

    def _customer_base(self):
        return segmentation.customer_base(self._lines_of_people(), self.sample.products())

    def _lines_of_people(self):
        """Lines with their person. Where no mart of the query needs reviews, they are not joined."""
        return self["stored_lines" if "stored_lines" in self._built else "stored_person_lines"]

    def _stored_summary(self):
        return materialize(self["order_summary"])

    def _stored_lines(self):
        return materialize(self["delivered_lines"])

    def _person_lines(self):
        return lines_plan.delivered_lines(self.sample.person_orders(), self.sample.items(), self.ctx)

    def _stored_person_lines(self):
        return materialize(self["person_lines"])

    def store(self, **names: str) -> None:
        """Store frames that do not read each other, side by side: by the name they get, what they hold."""
        self._built |= materialize_together(**{name: self[held] for name, held in names.items()})

    def _stored_base(self):
        return materialize(self["customer_base"])

    def _customer_segmentation(self):
        return segmentation.customer_segmentation(self["stored_base"], self.ctx)

    def _executive_monthly(self):
        return orders.executive_monthly(self["order_summary"], self.ctx)

    def _delivery_experience(self):
        return orders.delivery_experience(self["order_summary"], self.ctx)

    def _customer_segment_summary(self):
        return segmentation.customer_segment_summary(self["customer_segmentation"], self.ctx)

    def _customer_cross_segment(self):
        return segmentation.customer_cross_segment(self["customer_segmentation"], self.ctx)

    def _customer_category_affinity(self):
        return segmentation.customer_category_affinity(
            self._lines_of_people(), self.sample.products(), self["customer_segmentation"], self.ctx
        )

    def _category_performance(self):
        return performance.category_performance(self["stored_lines"], self.sample.products(), self.ctx)

    def _seller_performance(self):
        return performance.seller_performance(self["stored_lines"], self.sample.sellers(), self.ctx)

    def _full_summary(self):
        """The order summary with address, which holds every column and row of the orders."""
        s = self.sample
        return orders.order_summary(s.orders(), s.items(), s.payments(), s.reviews())

    def _quality_checks(self):
        s = self.sample
        self.store(stored_full_summary="full_summary", stored_person_lines="person_lines")
        summary = self["stored_full_summary"]
        return quality.quality_checks(
            {
                "fct_order": summary,
                "bridge_customer_order_address": s.bridge(),
                "fct_order_item": s.items(),
                "dim_product": s.products(),
                "dim_seller": s.sellers(),
                "order_summary": summary,
                "customer_segmentation": materialize(self["customer_segmentation"]),
                "delivered_lines": self["stored_person_lines"],
            },
            self.ctx,
        )


def _rounded(frame: DataFrame) -> DataFrame:
    """Doubles to nine places."""
    doubles = [name for name, kind in frame.dtypes if kind == "double"]
    return frame.withColumns({c: F.round(c, 9) for c in doubles})


def _table(name: str, ctx: BuildContext = CONTEXT):
    return lambda spark, sf_dir: _rounded(Canonical(spark, sf_dir, ctx)[name])


def _public(name: str):
    return lambda spark, sf_dir: _rounded(publication.public_rows(Canonical(spark, sf_dir)[name]))


def _model(build: Callable[[Sample], DataFrame]):
    return lambda spark, sf_dir: build(Sample(spark, sf_dir))


def _measures(table: str, *names: str, by: tuple[str, ...] = (), ranked: bool = False):
    def run(spark, sf_dir):
        tables = Canonical(spark, sf_dir).tables(table)
        measured = metrics.evaluate(tables, names, by, ranked)
        renamed = {name: name.lower().replace(" ", "_") for name in names}
        return _rounded(measured.withColumnsRenamed(renamed))

    return run


# model


def _order_summary_with_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Sample(spark, sf_dir)
    return _rounded(orders.order_summary(s.orders(), s.items(), s.payments(), s.reviews()))


def _fct_order(s: Sample) -> DataFrame:
    return model.fct_order(s.raw_orders(), model.bridge_customer_order_address(s.raw_customers()))


def _calendar(spark, sf_dir):
    months = Canonical(spark, sf_dir)["executive_monthly"].select("month_start", "as_of_date")
    return model.calendar(months)


def _default_as_of(spark, sf_dir):
    day = last_purchase_date(Sample(spark, sf_dir).raw_orders())
    return spark.range(1).select(F.lit(day).alias("as_of_date"))


def _typed_text(spark, sf_dir):
    """Each parser over text it accepts and text it refuses."""
    price, when = F.col("price"), F.col("shipping_limit_date")
    return Sample(spark, sf_dir).raw_order_items().select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        parse_int(price).alias("whole"),
        parse_decimal(price).alias("money"),
        parse_double(price).alias("number"),
        parse_double(F.concat(price, F.lit("d"))).alias("suffixed"),
        parse_int(F.concat(F.lit("n"), price)).alias("lettered"),
        parse_timestamp(when).alias("moment"),
        parse_timestamp(F.substring(when, 1, 7)).alias("month_only"),
        blank_to_null(F.concat(F.lit("  "), F.when(F.col("freight_value") == "1.0", F.lit("")).otherwise("x"))).alias(
            "trimmed"
        ),
    )


# segmentation


def _value_buckets(value: str):
    def run(spark, sf_dir):
        return value_buckets(Canonical(spark, sf_dir)["customer_base"], value)

    return run


def _bucket_cumulative(value: str):
    def run(spark, sf_dir):
        buckets = materialize(value_buckets(Canonical(spark, sf_dir)["customer_base"], value))
        return _rounded(bucket_cumulative(buckets, value))

    return run


def _abc_on_freight(spark, sf_dir):
    base = Canonical(spark, sf_dir)["stored_base"]
    return base.select(
        "customer_unique_id",
        "freight_value_brl",
        abc_class(base, "freight_value_brl", widths=(1_000, 10)).alias("freight_segment"),
    )


def _abc_of_suppliers(spark, sf_dir):
    """ABC over another entity: suppliers by the value they shipped."""
    items = Sample(spark, sf_dir).items()
    value = materialize(items.groupBy("seller_id").agg(F.sum("item_value_brl").cast("decimal(38,2)").alias("value_brl")))
    return value.select("seller_id", "value_brl", abc_class(value, "value_brl", (0.5, 0.9), ("A", "B", "C")).alias("class"))


def _prefix_by_state(spark, sf_dir):
    """Exclusive prefix sums within partitions: order value per nation."""
    s = Sample(spark, sf_dir)
    per_state = s.read("orders").join(s.read("customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.col("c_nationkey").alias("nation"), F.col("o_totalprice").cast("decimal(18,2)").alias("price_brl")
    )
    rows = per_state.agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("value_brl"))
    return prefix_sum(materialize(rows), "price_brl", "value_brl", ("nation",))


def _group_stats(spark, sf_dir):
    """Median and mode per event type, three groups that hold all events."""
    events = Sample(spark, sf_dir).read("events").select(
        "event_type", "value", F.col("user_id").cast("double").alias("user_number"), (F.col("user_id") % 7).alias("slot")
    )
    medians = group_median(events, "event_type", ["value", "user_number"], count="events")
    return medians.join(group_mode(events, "event_type", ["slot"]), "event_type", "left")


def _group_median_of_unknown(spark, sf_dir):
    """Medians where a key is NULL: the events of two users in three have no group of their own."""
    events = Sample(spark, sf_dir).read("events")
    keyed = events.select(F.when(F.col("user_id") % 3 == 0, F.col("event_type")).alias("known_type"), "value")
    return group_median(keyed, "known_type", ["value"], count="events")


def _group_median_of_strange(spark, sf_dir):
    """Medians over NaN, infinities and NULL, mixed in as many shares as there are groups."""
    events = Sample(spark, sf_dir).read("events")
    kind, share = F.col("event_id") * 7 % 10, F.col("user_id") % 11
    strange = F.when(kind < share, F.element_at(F.array(*[F.lit(float(x)) for x in ("nan", "inf", "-inf")]), _third()))
    value = F.coalesce(strange, F.when(F.col("event_id") % 13 != 0, F.col("value")))
    keyed = events.select(F.concat_ws("-", "event_type", share).alias("grp"), value.alias("value"))
    medians = group_median(keyed, "grp", ["value"], count="events")
    return medians.select("grp", "events", *_told_apart("value", F.col("value")))


def _third() -> Column:
    return (F.col("user_id") % 3 + 1).cast("int")


def _told_apart(name: str, value: Column) -> list[Column]:
    """A double as a finite number, NULL otherwise, and in words what else it is."""
    endless = F.abs(value) == float("inf")
    kind = F.when(F.isnan(value), "nan").when(endless & (value > 0), "inf").when(endless, "-inf")
    return [F.when(kind.isNull(), F.round(value, 9)).alias(name), kind.alias(f"{name}_kind")]


def _dim_geography_of_bad_points(spark, sf_dir):
    """Places where a third of all latitudes, and two thirds in every fifth place, are the text NaN."""
    raw = Sample(spark, sf_dir).raw_geolocation()
    zip_code = F.col("geolocation_zip_code_prefix").cast("int")
    cents = F.floor(F.abs(F.col("geolocation_lat").cast("double")) * 10_000).cast("long")
    bad = cents % 3 < F.when(zip_code % 5 == 0, 2).otherwise(1)
    places = model.dim_geography(
        raw.withColumn("geolocation_lat", F.when(bad, "NaN").otherwise(F.col("geolocation_lat")))
    )
    latitude = _told_apart("latitude", F.col("latitude"))
    return places.select("zip_code_prefix", *latitude, F.round("longitude", 9).alias("longitude"), "source_points")


# quality


def _orphans(key: str, rows: Callable[[Sample], DataFrame], parents: Callable[[Sample], DataFrame]):
    """Rows whose key the other table does not have, by key."""

    def run(spark, sf_dir):
        s = Sample(spark, sf_dir)
        return quality.orphan_rows(rows(s), parents(s), key)

    return run


def _invalid_chronology(spark, sf_dir):
    times = Sample(spark, sf_dir).order_times()
    return times.filter(orders.invalid_chronology()).select(
        "order_id", "purchased_at", "approved_at", "delivered_carrier_at", "delivered_customer_at"
    )


def _payment_differences(spark, sf_dir):
    summary = Canonical(spark, sf_dir)["order_summary"]
    return summary.filter(quality.payment_gap()).select(
        "order_id", "order_status", "paid_value_brl", "merchandise_gmv_brl", "freight_value_brl"
    )


def _key_surplus(spark, sf_dir):
    names = ["order_rows", "order_item_rows", "order_item_product_rows"]
    return nested_surplus(Sample(spark, sf_dir).items(), ["order_id", "order_item_id", "product_id"], names)


def _quality_summary(spark, sf_dir):
    return quality.quality_summary(Canonical(spark, sf_dir)["quality_checks"])


def _check_listing(spark, sf_dir):
    return quality.check_listing(Canonical(spark, sf_dir)["quality_checks"])


# publication


def _executive_facts(spark, sf_dir):
    canonical = Canonical(spark, sf_dir)
    canonical.store(order_summary="order_summary", stored_lines="delivered_lines")
    canonical.store(
        stored_base="customer_base",
        category_performance="category_performance",
        executive_monthly="executive_monthly",
        delivery_experience="delivery_experience",
    )
    tables = canonical.tables(
        "executive_monthly", "customer_segment_summary", "category_performance", "delivery_experience"
    )
    return _rounded(publication.executive_facts(tables))


def _headline_kpis(spark, sf_dir):
    canonical = Canonical(spark, sf_dir)
    canonical.store(executive_monthly="executive_monthly", stored_person_lines="person_lines")
    tables = canonical.tables("executive_monthly", "customer_segment_summary")
    return publication.headline_kpis(tables)


def _dataset(build: Callable[[DataFrame], DataFrame], table: str):
    return lambda spark, sf_dir: _rounded(build(Canonical(spark, sf_dir)[table]))


# Labels of the sample's brands.
BRAND_LABELS = {f"Brand#{i}": f"Marca {i}" for i in range(1, 26)}


def _top_brands(spark, sf_dir):
    """The first twelve of 25 groups."""
    canonical = Canonical(spark, sf_dir)
    brands = canonical.sample.read("part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("category_name")
    )
    brands = performance.category_performance(canonical["stored_lines"], brands, CONTEXT)
    return _rounded(publication.top_categories(brands, BRAND_LABELS))


def _category_labels(spark, sf_dir):
    """Labels of every category, and which have none in the published table."""
    named = Sample(spark, sf_dir).products().groupBy("category_name").agg(F.count("*").alias("products"))
    return named.withColumns(
        {
            "category_label": label_or_null(F.col("category_name"), PART_LABELS),
            "published_label": label_or_null(F.col("category_name"), CATEGORY_LABELS),
        }
    )


def _unmapped_categories(spark, sf_dir):
    return unmapped(Sample(spark, sf_dir).products(), "category_name", CATEGORY_LABELS)


def _display_text(spark, sf_dir):
    """Every display format over every order."""
    price = F.col("o_totalprice")
    return Sample(spark, sf_dir).read("orders").select(
        "o_orderkey",
        display.currency(price).alias("currency_text"),
        display.whole_number(F.floor(price)).alias("number_text"),
        display.two_decimals(F.floor(price) / 4).alias("decimal_text"),
        display.day(F.col("o_orderdate").cast("date")).alias("day_text"),
        display.month_label(F.col("o_orderdate").cast("date")).alias("month_text"),
        display.currency(F.when(F.col("o_orderkey") % 2 == 0, price)).alias("gap_text"),
        display.money_millions(price * 1000).alias("millions_text"),
    )


def _spreadsheet_guard(spark, sf_dir):
    """Whole documents, and the same behind each character a spreadsheet would run."""
    text = F.col("text")
    sign = F.element_at(F.array(*[F.lit(c) for c in "=+-@ "]), (F.col("doc_id") % 5 + 1).cast("int"))
    return Sample(spark, sf_dir).read("documents").select(
        "doc_id",
        display.spreadsheet_text(text).alias("text"),
        display.spreadsheet_text(F.concat(sign, text)).alias("signed_text"),
    )


def _suppressed_rows(spark, sf_dir):
    canonical = Canonical(spark, sf_dir)
    canonical.store(order_summary="order_summary", stored_lines="delivered_lines")
    suppressed = metrics.suppressed_rows(canonical.tables(*metrics.COVERED_TABLES))
    return suppressed.withColumnRenamed(metrics.SUPPRESSED_ROWS, "filas_suprimidas")


def _measures_by_calendar_month(spark, sf_dir):
    """GMV and orders through the calendar relationship."""
    monthly = materialize(Canonical(spark, sf_dir)["executive_monthly"])
    dated = metrics.with_calendar(monthly, "executive_monthly", model.calendar(monthly))
    measured = metrics.evaluate({"executive_monthly": dated}, ["Pedidos", "GMV"], ["Anio", "Mes indice"])
    return measured.withColumnsRenamed(
        {"Pedidos": "pedidos", "GMV": "gmv", "Anio": "anio", "Mes indice": "mes_indice"}
    )


# sources and sinks


def _new_folder(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/query-{uuid.uuid4()}"


def _published_roundtrip(spark, sf_dir):
    """A public mart written as CSV, checked against its contract and read back with its types."""
    folder = _new_folder(spark)
    mart = publication.public_rows(Canonical(spark, sf_dir)["seller_performance"])
    write_csv(mart.withColumn("seller_id", F.col("seller_id").cast("string")), f"{folder}/seller_performance")
    check_published(spark, folder, "seller_performance")
    return _rounded(read_published(spark, folder, "seller_performance"))


def _raw_frames(s: Sample) -> dict[str, DataFrame]:
    return {
        "raw_customers": s.raw_customers(),
        "raw_geolocation": s.raw_geolocation(),
        "raw_order_items": s.raw_order_items(),
        "raw_order_payments": s.raw_order_payments(),
        "raw_order_reviews": s.raw_order_reviews(),
        "raw_orders": s.raw_orders(),
        "raw_products": s.raw_products(),
        "raw_sellers": s.raw_sellers(),
        "raw_product_category_name_translation": s.raw_translation(),
    }


def _ingested(spark, sf_dir, buckets: int = 0, numbered: bool = False) -> tuple[Warehouse, str]:
    """All nine tables written as landing CSV and ingested. Files are packed, but for those that are read in
    ranges because their records may hold line breaks. The sample repeats line numbers within an order,
    which the gate refuses; ``numbered`` gives every line a number of its own."""
    folder = _new_folder(spark)
    frames = _raw_frames(Sample(spark, sf_dir))
    if numbered:
        items = frames["raw_order_items"]
        own = F.pmod(F.xxhash64(*items.columns), F.lit(2**31 - 1)).cast("string")
        frames["raw_order_items"] = items.withColumn("order_item_id", own)

    def land(raw: RawTable) -> None:
        packed = "none" if raw.free_text else "gzip"
        frames[raw.table].write.csv(
            f"{folder}/landing/{raw.file}", header=True, quote='"', escape='"', compression=packed
        )

    with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
        list(pool.map(inheritable_thread_target(spark)(land), RAW_TABLES))
    warehouse = Warehouse(spark, f"{folder}/warehouse", buckets)
    ingest(warehouse, f"{folder}/landing")
    return warehouse, folder


def _ingest_row_counts(spark, sf_dir):
    warehouse, _ = _ingested(spark, sf_dir)
    counted = [
        frame.agg(F.lit(name).alias("source_table"), F.count("*").alias("source_rows"))
        for name, frame in warehouse.tables("ingest").items()
    ]
    return reduce(DataFrame.unionAll, counted)


def _ingest_state(spark, sf_dir):
    warehouse, _ = _ingested(spark, sf_dir)
    return warehouse.ingest_state().select("schema_version", "source_tables", "source_rows")


def _ingested_order_items(spark, sf_dir):
    """Items after a trip through CSV, the warehouse and the typed model."""
    warehouse, _ = _ingested(spark, sf_dir)
    return model.fct_order_item(warehouse.tables("ingest")["raw_order_items"])


def _pipeline_mart(name: str, buckets: int = 0):
    """A mart of a whole run: landing files, ingest, build. Its build id is new every time."""

    def run(spark, sf_dir):
        warehouse, _ = _ingested(spark, sf_dir, buckets)
        build(warehouse, CONTEXT.as_of)
        return _rounded(warehouse.tables("build")[name].drop("build_id"))

    return run


def _gate_of_a_run(spark, sf_dir):
    """What the gate says of a whole run, and whether an export got through it."""
    warehouse, folder = _ingested(spark, sf_dir)
    build(warehouse, CONTEXT.as_of)
    result = validate(warehouse, f"{folder}/reports", raise_on_failure=False)
    try:
        published = f"{export(warehouse, f'{folder}/published').path}/public"
        check_all_published(spark, published, may_be_empty=True)
        exported = True
    except PublicationBlocked:
        exported = False
    row = (result.checks, result.high_failures, result.medium_warnings, exported)
    return spark.createDataFrame([row], "checks long, high_failures long, medium_warnings long, exported boolean")


def _exported(spark, sf_dir) -> str:
    """Folder of the export of a run that passed the gate."""
    warehouse, folder = _ingested(spark, sf_dir, numbered=True)
    build(warehouse, CONTEXT.as_of)
    path = export(warehouse, f"{folder}/published").path
    check_all_published(spark, f"{path}/public", may_be_empty=True)
    return path


def _exported_tables(spark, sf_dir):
    """Of each published table its rows by the manifest, as internal files and as public ones."""
    path = _exported(spark, sf_dir)
    manifest = spark.read.json(f"{path}/manifest").select("high_failures", "rows.*")
    stated = manifest.unpivot(["high_failures"], list(publication.EXPORT_TABLES), "table_name", "manifest_rows")

    def counted(name: str) -> DataFrame:
        csv = spark.read.csv(f"{path}/internal/csv/{name}", header=True, quote='"', escape='"')
        sheet = spark.read.csv(f"{path}/internal/spreadsheet/{name}", header=True, quote='"', escape='"')
        found = {"csv": csv, "spreadsheet": sheet, "public": read_published(spark, f"{path}/public", name)}
        sides = [frame.select(F.lit(side).alias("side")) for side, frame in found.items()]
        rows = [F.count_if(F.col("side") == side).alias(f"{side}_rows") for side in found]
        return reduce(DataFrame.unionAll, sides).agg(F.lit(name).alias("table_name"), *rows)

    return stated.join(reduce(DataFrame.unionAll, map(counted, publication.EXPORT_TABLES)), "table_name")


def _exported_public(name: str):
    def run(spark, sf_dir):
        return _rounded(read_published(spark, f"{_exported(spark, sf_dir)}/public", name).drop("build_id"))

    return run


def _refusal(act: Callable[[], object]) -> str:
    """What an act is refused with; ``accepted`` if it is not."""
    try:
        act()
    except (FileNotFoundError, ValueError, ConcurrentRun) as error:
        return str(error)
    return "accepted"


def _run_outcomes(spark, sf_dir):
    """What ingest and build say of right and of broken sources, and which run readers see afterwards."""
    warehouse, folder = _ingested(spark, sf_dir)
    landing, first = f"{folder}/landing", warehouse.current("ingest")
    again = ingest(warehouse, landing)
    forced = ingest(warehouse, landing, force=True)
    outcomes = {
        "second ingest": "the same" if again.ingest_run_id == first["run_id"] else "another",
        "forced ingest": "the same" if forced.ingest_run_id == first["run_id"] else "another",
        "forced rows": str(forced.rows),
    }

    frames = _raw_frames(Sample(spark, sf_dir))
    for raw in RAW_TABLES:
        head = frames[raw.table].limit(0)
        if raw.table == "raw_sellers":
            head = head.select(*reversed(head.columns))
        head.write.csv(f"{folder}/swapped/{raw.file}", header=True)
        if raw.table not in ("raw_orders", "raw_products"):
            head.write.csv(f"{folder}/partial/{raw.file}", header=True)
    outcomes["missing sources"] = _refusal(lambda: ingest(warehouse, f"{folder}/partial", force=True))
    outcomes["swapped columns"] = _refusal(lambda: ingest(warehouse, f"{folder}/swapped", force=True))
    outcomes["ingest afterwards"] = "kept" if warehouse.current("ingest")["run_id"] == forced.ingest_run_id else "lost"
    outcomes["overtaken ingest"] = _refusal(
        lambda: warehouse.commit("ingest", "late", {"t": 0}, based_on=first["version"])
    )

    started = spark.range(1).select(F.current_timestamp()).first()[0]
    built = build(warehouse, CONTEXT.as_of)
    ended = spark.range(1).select(F.current_timestamp()).first()[0]
    tables = warehouse.tables("build")
    outcomes["tables"] = str(table_count(warehouse))
    outcomes["tables built"] = str(built.tables_built)
    outcomes["build time"] = str(started <= tables["build_context"].first()["built_at"] <= ended)
    outcomes["dashboard columns"] = _refusal(lambda: publication.require_dashboard_columns(tables))
    lacking = tables | {"executive_monthly": tables["executive_monthly"].drop("units", "as_of_date")}
    outcomes["lacking columns"] = _refusal(lambda: publication.require_dashboard_columns(lacking))
    without = {name: frame for name, frame in tables.items() if name != "executive_monthly"}
    outcomes["lacking table"] = _refusal(lambda: publication.require_dashboard_columns(without))
    return spark.createDataFrame(list(outcomes.items()), "outcome string, said string")


def _landed_digests(spark, sf_dir):
    """Customers landed as a file for each five hundred ids, and what the manifest says of every file."""
    folder = f"{_new_folder(spark)}/customers"
    rows = Sample(spark, sf_dir).read("customer").select(
        F.floor(F.col("c_custkey") / 500).alias("part"), "c_custkey", "c_mktsegment"
    )
    rows.repartition("part").sortWithinPartitions("part", "c_custkey").write.partitionBy("part").csv(folder)
    files = landing_manifest(spark, folder, "*.csv")
    part = F.regexp_extract("path", "part=([0-9]+)", 1).cast("long")
    return files.select(part.alias("part"), "bytes", "sha256")


def _landing_manifest(spark, sf_dir):
    return landing_manifest(spark, sf_dir, "*.parquet").select("file", "bytes", "sha256")


def _snapshot_manifest(spark, sf_dir):
    files = landing_manifest(spark, sf_dir, "*.parquet")
    return snapshot_manifest(files, "sample", sf_dir).select("dataset", "files", "bytes")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly executive view over the order summary."""
    return Canonical(spark, sf_dir)["executive_monthly"]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # typed model from raw text
    "dim_customer": _model(lambda s: model.dim_customer(s.raw_customers())),
    "bridge_customer_order_address": _model(lambda s: model.bridge_customer_order_address(s.raw_customers())),
    "dim_geography": _model(lambda s: _rounded(model.dim_geography(s.raw_geolocation()))),
    "dim_geography_of_bad_points": _dim_geography_of_bad_points,
    "dim_product": _model(lambda s: model.dim_product(s.raw_products(), s.raw_translation())),
    "dim_seller": _model(lambda s: model.dim_seller(s.raw_sellers())),
    "fct_order": _model(_fct_order),
    "fct_order_item": _model(lambda s: model.fct_order_item(s.raw_order_items())),
    "fct_payment": _model(lambda s: model.fct_payment(s.raw_order_payments())),
    "fct_review": _model(lambda s: model.fct_review(s.raw_order_reviews())),
    "dim_date": _model(lambda s: model.dim_date(_fct_order(s))),
    "calendar": _calendar,
    "default_as_of": _default_as_of,
    "typed_text": _typed_text,
    # marts
    "order_summary": _order_summary_with_address,
    "executive_monthly": _table("executive_monthly"),
    "delivered_lines": _table("delivered_lines"),
    "customer_base": _table("customer_base"),
    "value_buckets": _value_buckets("merchandise_gmv_brl"),
    "value_buckets_freight": _value_buckets("freight_value_brl"),
    "bucket_cumulative": _bucket_cumulative("merchandise_gmv_brl"),
    "bucket_cumulative_freight": _bucket_cumulative("freight_value_brl"),
    "customer_segmentation": _table("customer_segmentation"),
    "abc_on_freight": _abc_on_freight,
    "abc_of_suppliers": _abc_of_suppliers,
    "prefix_by_state": _prefix_by_state,
    "group_stats": _group_stats,
    "group_median_of_unknown": _group_median_of_unknown,
    "group_median_of_strange": _group_median_of_strange,
    "customer_segment_summary": _table("customer_segment_summary"),
    "customer_cross_segment": _table("customer_cross_segment"),
    "customer_category_affinity": _table("customer_category_affinity"),
    "category_performance": _table("category_performance"),
    "seller_performance": _table("seller_performance"),
    "seller_performance_1995": _table("seller_performance", EARLY),
    "delivery_experience": _table("delivery_experience"),
    # quality
    "quality_checks": _table("quality_checks"),
    "quality_summary": _quality_summary,
    "check_listing": _check_listing,
    "key_surplus": _key_surplus,
    "orphan_orders_without_items": _orphans("order_id", lambda s: s.order_times(), lambda s: s.items()),
    "orphan_orders_without_reviews": _orphans("order_id", lambda s: s.order_times(), lambda s: s.reviews()),
    "orphan_reviews_without_order": _orphans("order_id", lambda s: s.reviews(), lambda s: s.order_times()),
    "orphan_documents_without_labels": _orphans("doc_id", lambda s: s.read("documents"), lambda s: s.read("labels")),
    "invalid_chronology": _invalid_chronology,
    "payment_differences": _payment_differences,
    # publication
    "public_executive_monthly": _public("executive_monthly"),
    "public_customer_segment_summary": _public("customer_segment_summary"),
    "public_customer_cross_segment": _public("customer_cross_segment"),
    "public_customer_category_affinity": _public("customer_category_affinity"),
    "public_category_performance": _public("category_performance"),
    "public_seller_performance": _public("seller_performance"),
    "public_delivery_experience": _public("delivery_experience"),
    "public_quality_checks": _public("quality_checks"),
    "coverage_filter_on_segmentation": _public("customer_segmentation"),
    "executive_facts": _executive_facts,
    "headline_kpis": _headline_kpis,
    "monthly_series": _dataset(publication.monthly_series, "executive_monthly"),
    "value_segments": _dataset(publication.value_segments, "customer_segment_summary"),
    "top_category": _dataset(publication.top_category, "category_performance"),
    "top_categories": _dataset(lambda c: publication.top_categories(c, PART_LABELS), "category_performance"),
    "top_brands": _top_brands,
    "delivery_summary": _dataset(publication.delivery_summary, "delivery_experience"),
    "category_labels": _category_labels,
    "unmapped_categories": _unmapped_categories,
    "display_text": _display_text,
    "spreadsheet_guard": _spreadsheet_guard,
    # measures
    "measures_monthly": _measures(
        "executive_monthly",
        "Pedidos",
        "Pedidos entregados",
        "GMV",
        "Ticket promedio",
        "Tasa de pedidos fallidos",
        "Tasa de entrega tardia",
    ),
    "measures_by_month": _measures("executive_monthly", "GMV", "Ticket promedio", by=("month_start",)),
    "measures_by_calendar_month": _measures_by_calendar_month,
    "measures_segments": _measures(
        "customer_segment_summary",
        "Clientes elegibles",
        "Clientes alto valor",
        "Share GMV alto valor",
        "Clientes una categoria",
        "GMV por segmento",
    ),
    "measures_by_segment": _measures("customer_segment_summary", "GMV por segmento", by=("segment_label",), ranked=True),
    "measures_cross": _measures(
        "customer_cross_segment", "Clientes cruce", by=("value_segment", "unit_segment", "category_segment")
    ),
    "measures_affinity": _measures(
        "customer_category_affinity", "GMV afinidad", by=("category_name", "value_segment"), ranked=True
    ),
    "measures_category": _measures("category_performance", "GMV categorias", "Review categoria"),
    "measures_by_category": _measures("category_performance", "GMV categorias", by=("category_name",), ranked=True),
    "measures_delivery": _measures(
        "delivery_experience",
        "Ordenes entrega",
        "Ordenes tardias",
        "Tasa tardia publicable",
        "Review ponderada",
        "Review a tiempo",
        "Review tardia",
    ),
    "measures_delivery_by_month": _measures("delivery_experience", "Tasa tardia publicable", by=("month_start",)),
    "measures_delivery_by_status": _measures("delivery_experience", "Review ponderada", by=("delivery_status",)),
    "measures_sellers": _measures(
        "seller_performance", "Vendedores publicables", "GMV vendedores", "Tasa tardia vendedores"
    ),
    "measures_sellers_by_state": _measures("seller_performance", "Tasa tardia vendedores", by=("seller_state",), ranked=True),
    "measures_quality": _measures(
        "quality_checks",
        "Controles",
        "Fallas altas",
        "Advertencias medias",
        "Tasa controles aprobados",
        "Valor observado fallas",
    ),
    "measures_quality_by_status": _measures("quality_checks", "Controles", by=("status",)),
    "suppressed_rows": _suppressed_rows,
    # sources and sinks
    "ingest_row_counts": _ingest_row_counts,
    "ingest_state": _ingest_state,
    "ingested_order_items": _ingested_order_items,
    "pipeline_segment_summary": _pipeline_mart("customer_segment_summary"),
    "pipeline_seller_performance_in_buckets": _pipeline_mart("seller_performance", buckets=4),
    "published_roundtrip": _published_roundtrip,
    "gate_of_a_run": _gate_of_a_run,
    "exported_tables": _exported_tables,
    "exported_public_category_performance": _exported_public("category_performance"),
    "run_outcomes": _run_outcomes,
    "landed_digests": _landed_digests,
    "landing_manifest": _landing_manifest,
    "snapshot_manifest": _snapshot_manifest,
}
