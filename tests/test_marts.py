"""The traps of the mart definitions, each on the small story with one thing changed."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from orderlens.plans import lines, model, orders, performance, quality, segmentation
from orderlens.plans.context import BuildContext, last_purchase_date, resolve_context
from orderlens.session import materialize
from tests.conftest import crowd_rows, find, raw_frames, story_rows

LATE_CUT = BuildContext(date(2019, 12, 31), "b")


class Marts:
    def __init__(self, spark, rows, ctx=LATE_CUT):
        self.raw = raw_frames(spark, rows)
        self.t = model.build_model(self.raw)
        self.ctx = ctx
        t = self.t
        self.summary = orders.order_summary(t["fct_order"], t["fct_order_item"], t["fct_payment"], t["fct_review"])
        self.lines = lines.delivered_lines(self.summary, t["fct_order_item"], ctx)

    @property
    def base(self):
        return segmentation.customer_base(self.lines, self.t["dim_product"])

    @property
    def segments(self):
        return segmentation.customer_segmentation(materialize(self.base), self.ctx)

    def checks(self):
        tables = dict(
            self.t, order_summary=self.summary, customer_segmentation=self.segments, delivered_lines=self.lines
        )
        found = quality.quality_checks(tables, self.ctx).collect()
        return {c.check_id: (c.status, c.observed_value) for c in found}


def test_an_order_without_facts_has_zeros_and_no_score(spark):
    rows = story_rows()
    bare = dict.fromkeys(rows["raw_orders"][0], "")
    bare |= {"order_id": "o501", "customer_id": "c101", "order_status": "Shipped ", "order_purchase_timestamp": "2019-03-04"}
    rows["raw_orders"].append(bare)
    order = Marts(spark, rows).summary.filter("order_id = 'o501'").first()
    assert (order.units, order.distinct_products, order.distinct_sellers) == (0, 0, 0)
    assert (order.merchandise_gmv_brl, order.freight_value_brl, order.paid_value_brl) == (0, 0, 0)
    assert (order.payment_rows, order.payment_methods, order.review_rows) == (0, 0, 0)
    assert (order.review_score, order.delivery_delay_days, order.is_late) == (None, None, None)
    assert order.order_status == "shipped"


def test_late_by_the_clock_with_no_day_of_delay(spark):
    rows = story_rows()
    order = find(rows, "raw_orders", order_id="o101")
    order["order_delivered_customer_date"] = "2019-03-10 14:00:00"
    order["order_estimated_delivery_date"] = "2019-03-10 00:00:00"
    order = Marts(spark, rows).summary.filter("order_id = 'o101'").first()
    assert (order.delivery_delay_days, order.is_late) == (0, True)


def test_months_without_deliveries_keep_null_money(spark):
    rows = story_rows()
    for number in ("o301", "o401"):
        find(rows, "raw_orders", order_id=number)["order_status"] = "CANCELED"
    months = orders.executive_monthly(Marts(spark, rows).summary, LATE_CUT).orderBy("month_start").collect()
    march, april = months
    assert (march.orders, march.customers, march.delivered_orders, march.failed_orders) == (3, 2, 3, 0)
    assert (march.merchandise_gmv_brl, march.units) == (960, 4)
    assert march.late_delivery_rate == pytest.approx(1 / 3)
    assert march.avg_review_score == pytest.approx((5 + 4 + 2.5) / 3)
    assert (april.orders, april.customers, april.delivered_orders, april.failed_orders) == (2, 2, 0, 2)
    for column in ("merchandise_gmv_brl", "units", "avg_order_value_brl", "avg_review_score", "late_delivery_rate"):
        assert april[column] is None


def test_reviews_average_per_order_first(spark):
    """Ivo's order has two reviews; its score counts once among orders and once per line among items."""
    marts = Marts(spark, story_rows())
    delivery = orders.delivery_experience(marts.summary, LATE_CUT)
    late = delivery.filter("delivery_status = 'LATE'").first()
    assert (late.orders, late.reviewed_orders, late.avg_review_score, late.avg_delivery_delay_days) == (1, 1, 2.5, 3.0)
    by_category = performance.category_performance(marts.lines, marts.t["dim_product"], LATE_CUT)
    lighting = by_category.filter("category_name = 'lighting'").first()
    assert (lighting.orders, lighting.customers, lighting.units) == (4, 3, 4)
    assert lighting.avg_review_score == pytest.approx((5 + 4 + 2.5 + 3) / 4)
    seller = performance.seller_performance(marts.lines, marts.t["dim_seller"], LATE_CUT).first()
    assert seller.avg_review_score == pytest.approx((5 + 4 + 2 * 2.5 + 4 * 3 + 5) / 9)
    assert seller.late_delivery_rate == pytest.approx(2 / 9)


def test_invalid_chronology_leaves_delivery_but_not_the_monthly_rate(spark):
    rows = story_rows()
    find(rows, "raw_orders", order_id="o201")["order_approved_at"] = "2019-03-01 00:00:00"  # before it was bought
    marts = Marts(spark, rows)
    assert orders.delivery_experience(marts.summary, LATE_CUT).filter("delivery_status = 'LATE'").count() == 0
    march = orders.executive_monthly(marts.summary, LATE_CUT).orderBy("month_start").first()
    assert march.late_delivery_rate == pytest.approx(1 / 3)
    assert marts.checks()["invalid_order_chronology_source"] == ("FAIL", 1.0)


def test_unknown_times_keep_the_row_as_unknown(spark):
    rows = story_rows()
    order = find(rows, "raw_orders", order_id="o101")
    for column in list(order)[4:]:
        order[column] = ""
    unknown = orders.delivery_experience(Marts(spark, rows).summary, LATE_CUT).filter("delivery_status = 'UNKNOWN'").first()
    assert (unknown.orders, unknown.avg_delivery_delay_days, unknown.reviewed_orders) == (1, None, 1)


def test_the_cut_is_on_the_purchase_date_only(spark):
    ctx = BuildContext(date(2019, 3, 11), "b")
    marts = Marts(spark, story_rows(), ctx)
    delivery = {d.delivery_status: d.orders for d in orders.delivery_experience(marts.summary, ctx).collect()}
    assert delivery == {"ON_TIME": 1, "LATE": 1}
    assert marts.summary.count() == 5


def test_blank_people_stay_out_of_the_dimension_only(spark):
    rows = story_rows()
    find(rows, "raw_customers", customer_id="c101")["customer_unique_id"] = "  "
    marts = Marts(spark, rows)
    assert marts.t["dim_customer"].count() == 4
    assert marts.t["bridge_customer_order_address"].count() == 5
    assert {r.customer_unique_id for r in marts.base.collect()} == {"  ", "nora", "ivo", "lia", "tom"}
    assert marts.checks()["orders_without_customer"] == ("PASS", 0.0)


def test_a_missing_person_is_an_orphan_and_not_segmented(spark):
    rows = story_rows()
    rows["raw_customers"].remove(find(rows, "raw_customers", customer_unique_id="lia"))
    marts = Marts(spark, rows)
    assert marts.base.count() == 3
    assert marts.checks()["orders_without_customer"] == ("FAIL", 1.0)


def test_translations_match_the_text_as_delivered(spark):
    rows = story_rows()
    find(rows, "raw_products", product_id="lamp")["product_category_name"] = " luminarias"
    product = model.build_model(raw_frames(spark, rows))["dim_product"].filter("product_id = 'lamp'").first()
    assert (product.category_name_pt, product.category_name) == ("luminarias", "unknown")


def test_a_product_unknown_to_the_dimension_counts_for_people_only(spark):
    rows = story_rows()
    rows["raw_products"].remove(find(rows, "raw_products", product_id="lamp"))
    marts = Marts(spark, rows)
    person = marts.base.filter("customer_unique_id = 'nora'").first()
    assert (person.delivered_orders, person.units, person.distinct_products) == (2, 2, 1)
    assert (person.distinct_categories, person.merchandise_gmv_brl, person.freight_value_brl) == (0, 820, 20)
    named = performance.category_performance(marts.lines, marts.t["dim_product"], LATE_CUT)
    assert {c.category_name for c in named.collect()} == {"novels", "kites", "unknown"}
    assert marts.checks()["items_without_product"] == ("FAIL", 4.0)


def test_negative_values_count_for_categories_but_not_for_people(spark):
    rows = story_rows()
    find(rows, "raw_order_items", order_id="o101")["price"] = "-5"
    marts = Marts(spark, rows)
    nora = marts.base.filter("customer_unique_id = 'nora'").first()
    assert (nora.delivered_orders, nora.units, nora.merchandise_gmv_brl) == (1, 1, 320)
    by_category = performance.category_performance(marts.lines, marts.t["dim_product"], LATE_CUT)
    lighting = by_category.filter("category_name = 'lighting'").first()
    assert (lighting.units, lighting.merchandise_gmv_brl) == (4, 395)


def test_a_doubled_product_fails_the_reconciliation(spark):
    rows = story_rows()
    rows["raw_products"].append(dict(find(rows, "raw_products", product_id="lamp")))
    checks = Marts(spark, rows).checks()
    assert checks["customer_gmv_reconciliation"] == ("FAIL", 900.0)
    assert checks["orders_pk_unique"] == ("PASS", 0.0)


def test_a_doubled_seller_weighs_twice_in_its_mart_only(spark):
    rows = story_rows()
    rows["raw_sellers"] *= 2
    marts = Marts(spark, rows)
    seller = performance.seller_performance(marts.lines, marts.t["dim_seller"], LATE_CUT).first()
    assert (seller.orders, seller.units, seller.merchandise_gmv_brl) == (5, 18, 2000)
    assert seller.late_delivery_rate == pytest.approx(2 / 9)
    status = {status for check, (status, _) in marts.checks().items() if check != "unknown_product_categories"}
    assert status == {"PASS"}


def test_keys_repeated_or_missing_are_surplus(spark):
    rows = story_rows()
    item = find(rows, "raw_order_items", order_id="o101")
    rows["raw_order_items"] += [
        dict(item),
        item | {"order_item_id": "x", "price": 1},
        item | {"order_id": None, "seller_id": None, "price": 1},
    ]
    rows["raw_customers"].append(dict(find(rows, "raw_customers", customer_id="c101")))
    checks = Marts(spark, rows).checks()
    assert checks["order_items_pk_unique"] == ("FAIL", 3.0)
    assert checks["items_without_order"] == ("FAIL", 1.0)
    assert checks["items_without_seller"] == ("FAIL", 1.0)
    assert checks["customers_bridge_pk_unique"] == ("FAIL", 1.0)
    assert checks["orders_pk_unique"] == ("FAIL", 1.0)


def test_no_eligible_value_fails_the_reconciliation(spark):
    rows = story_rows()
    for order in rows["raw_orders"]:
        order["order_status"] = "shipped"
    checks = Marts(spark, rows).checks()
    assert len(checks) == 15
    assert checks["customer_gmv_reconciliation"] == ("FAIL", None)
    assert checks["customer_segment_unique"] == ("PASS", 0.0)


def test_payment_gaps_of_failed_orders_are_not_reported(spark):
    rows = story_rows()
    find(rows, "raw_order_payments", order_id="o101")["payment_value"] = "518.99"
    find(rows, "raw_order_payments", order_id="o301")["payment_value"] = "43"
    assert Marts(spark, rows).checks()["orders_payment_difference_gt_1"] == ("FAIL", 1.0)
    find(rows, "raw_orders", order_id="o101")["order_status"] = "unavailable"
    assert Marts(spark, rows).checks()["orders_payment_difference_gt_1"] == ("PASS", 0.0)


def test_no_value_comes_before_the_share(spark):
    rows = story_rows()
    for item in rows["raw_order_items"]:
        item["price"] = 0
    assert {s.value_segment for s in Marts(spark, rows).segments.collect()} == {"NO_VALUE"}


def test_every_dimension_counts_every_person_once(spark):
    marts = Marts(spark, story_rows())
    segments = marts.segments
    summary = segmentation.customer_segment_summary(segments, LATE_CUT)
    totals = summary.groupBy("segment_dimension").agg(
        F.sum("customers").alias("n"), F.sum("merchandise_gmv_brl").alias("gmv"), F.sum("units").alias("u"), F.sum("gmv_share").alias("share")
    )
    found = {t.segment_dimension: (t.n, t.gmv, t.u, round(t.share, 9)) for t in totals.collect()}
    assert found == {d: (4, 1000, 9, 1.0) for d in ("VALUE", "UNITS", "CATEGORIES")}
    assert segmentation.customer_cross_segment(segments, LATE_CUT).agg(F.sum("customers")).first()[0] == 4
    affinity = segmentation.customer_category_affinity(marts.lines, marts.t["dim_product"], segments, LATE_CUT)
    assert affinity.agg(F.sum("merchandise_gmv_brl"), F.sum("units")).first() == (1000, 9)


def test_products_are_joined_to_reduced_lines(spark):
    """Each line is aggregated before it meets the products, and none is copied for a distinct count."""
    marts = Marts(spark, story_rows())
    stored, products = materialize(marts.lines), materialize(marts.t["dim_product"])
    base = segmentation.customer_base(stored, products)
    affinity = segmentation.customer_category_affinity(stored, products, materialize(marts.segments), LATE_CUT)
    for frame in (base, affinity, performance.category_performance(stored, products, LATE_CUT)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString().split("\n")
        joins = [i for i, line in enumerate(plan) if "Join" in line and "product_id" in line]
        assert joins
        for i in joins:
            assert "Aggregate [customer_unique_id" in plan[i + 1] or "Aggregate [product_id" in plan[i + 1], plan[i + 1]


def test_dim_date_spans_all_purchases(spark):
    days = model.build_model(raw_frames(spark, story_rows()))["dim_date"].orderBy("date_day").collect()
    assert (days[0].date_day, days[-1].date_day, len(days)) == (date(2019, 3, 4), date(2019, 4, 8), 36)
    first_sunday = next(d for d in days if d.date_day == date(2019, 3, 10))
    assert (first_sunday.weekday_number, first_sunday.quarter_number, first_sunday.year_month) == (0, 1, "2019-03")
    assert days[-1].month_start == date(2019, 4, 1)


def test_the_calendar_reaches_the_cut(spark):
    ctx = BuildContext(date(2019, 4, 20), "b")
    months = orders.executive_monthly(Marts(spark, story_rows(), ctx).summary, ctx)
    days = model.calendar(months).orderBy("Fecha").collect()
    assert (days[0]["Fecha"], days[-1]["Fecha"]) == (date(2019, 3, 1), date(2019, 4, 20))
    assert (days[-1]["Anio"], days[-1]["Mes numero"], days[-1]["Mes indice"], days[-1]["Mes"]) == (2019, 4, 201904, "abr 2019")
    assert model.calendar(months.limit(0)).count() == 0


def test_the_default_cut_is_the_last_purchase_that_parses(spark):
    rows = story_rows()
    find(rows, "raw_orders", order_id="o401")["order_purchase_timestamp"] = "2019-04"
    raw = raw_frames(spark, rows)
    assert last_purchase_date(raw["raw_orders"]) == date(2019, 4, 2)
    assert resolve_context(raw["raw_orders"], date(2018, 1, 1)).as_of == date(2018, 1, 1)


def test_a_person_with_all_orders_is_counted_once(spark):
    """The hot person: sixty orders, one row, and a single class."""
    marts = Marts(spark, crowd_rows())
    person = marts.segments.first()
    assert (person.delivered_orders, person.units, person.distinct_products, person.distinct_categories) == (60, 60, 1, 1)
    assert (person.value_segment, person.unit_segment, person.category_segment) == ("A_HIGH_VALUE", "FOUR_PLUS", "SPECIALIST")
