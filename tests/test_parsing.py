"""Typed parsing, the NULL rules and display text."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.functions import display
from orderlens.functions.labels import CATEGORY_LABELS, SEGMENT_LABELS, label, unmapped
from orderlens.functions.measures import finite, mean, money_sum, on_or_before, rate, ratio, weighted_mean
from orderlens.functions.parsing import (
    blank_to_null,
    lower_text,
    parse_decimal,
    parse_double,
    parse_int,
    parse_timestamp,
    upper_text,
)


def _apply(spark, function, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in rows.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def test_integers_round_halves_away_and_refuse_the_rest(spark):
    text = ["1.5", "2.5", "-1.5", "-2.5", " 7 ", "01037", "1e3", "0.4", "", "abc", "99999999999", None, "1,5", "１"]
    assert _apply(spark, parse_int, text) == [2, 3, -2, -3, 7, 1037, 1000, 0, None, None, None, None, None, None]


def test_decimals_keep_cents(spark):
    text = ["1.005", "2.675", "-1.005", " 1.5", "1E-2", "12345678901234567", "x", None]
    expected = [Decimal("1.01"), Decimal("2.68"), Decimal("-1.01"), Decimal("1.50"), Decimal("0.01"), None, None, None]
    assert _apply(spark, parse_decimal, text) == expected


def test_doubles_refuse_java_suffixes(spark):
    assert _apply(spark, parse_double, ["1.5", "1d", "1F", "inf", "", "0x10"]) == [1.5, None, None, float("inf"), None, None]


def test_timestamps_need_a_whole_day(spark):
    text = ["2018", "2018-01", "2018-01-02", "2018-1-2", "2018-01-02 03:04:05", "2018-02-30", "2018-01-02 25:00:00"]
    text += [" 2018-01-02", "2018-01-02 ", "2018-01-02 03", "2018-01-02T03:04", "2018-01-02abc", None]
    day = datetime(2018, 1, 2)
    assert _apply(spark, parse_timestamp, text) == (
        [None, None, day, day, datetime(2018, 1, 2, 3, 4, 5), None, None]
        + [day, None, None, datetime(2018, 1, 2, 3, 4), None, None]
    )


def test_blank_text_is_null(spark):
    assert _apply(spark, blank_to_null, ["  x ", "   ", "", None]) == ["x", None, None, None]
    assert _apply(spark, lower_text, [" Delivered", " "]) == ["delivered", None]
    assert _apply(spark, upper_text, ["sp ", ""]) == ["SP", None]


def test_sums_and_averages_of_nothing_are_null(spark):
    rows = spark.createDataFrame([(Decimal("1.10"), 4, True), (Decimal("2.20"), None, None)], "v decimal(18,2), n int, b boolean")
    none = F.lit(False)
    row = rows.agg(
        money_sum(F.col("v")).alias("sum"),
        money_sum(F.col("v"), none).alias("no_sum"),
        mean(F.col("v")).alias("mean"),
        mean(F.col("v"), none).alias("no_mean"),
        rate(F.col("b")).alias("rate"),
        rate(F.col("b"), none).alias("no_rate"),
        ratio(F.sum("n"), F.lit(0)).alias("by_zero"),
        weighted_mean(F.col("v"), F.col("n")).alias("weighted"),
        weighted_mean(F.col("v"), F.lit(0)).alias("no_weight"),
    ).first()
    assert (row["sum"], row["no_sum"]) == (Decimal("3.30"), None)
    assert row["mean"] == pytest.approx(1.65)
    assert (row["no_mean"], row["rate"], row["no_rate"], row["by_zero"], row["no_weight"]) == (None, 1.0, None, None, None)
    assert row["weighted"] == pytest.approx(1.1)


def test_finite_drops_nan_and_infinities(spark):
    values = [1.0, None, float("nan"), float("inf"), float("-inf")]
    assert _apply(spark, finite, values, "double") == [1.0, None, None, None, None]


def test_the_cut_keeps_the_whole_day(spark):
    stamps = [datetime(2018, 1, 31, 23, 59, 59), datetime(2018, 2, 1), None]
    kept = _apply(spark, lambda c: on_or_before(c, date(2018, 1, 31)), stamps, "timestamp_ntz")
    assert kept == [True, False, None]


def test_display_text(spark):
    assert _apply(spark, display.money_millions, [1_250_000.0, 2_000_000.0], "double") == ["R$ 1,2 M", "R$ 2,0 M"]
    assert _apply(spark, display.currency, [1_250_000.5, 0.0], "double") == ["R$ 1.250.000,50", "R$ 0,00"]
    assert _apply(spark, display.whole_number, [12345], "bigint") == ["12.345"]
    assert _apply(spark, display.two_decimals, [4.25, 1234.5, 0.125], "double") == ["4,25", "1234,50", "0,12"]
    assert _apply(spark, display.day, ["2018-02-01", "soon", None]) == ["01/02/2018", "soon", "Sin datos"]
    assert _apply(spark, display.month_label, [date(2018, 1, 5), date(2016, 12, 1)], "date") == ["ene 2018", "dic 2016"]
    for show in (display.money_millions, display.currency, display.whole_number, display.two_decimals):
        missing = [None, float("nan"), float("inf"), float("-inf")]
        assert _apply(spark, show, missing, "double") == ["Sin datos"] * 4


def test_formula_text_is_quoted(spark):
    text = ["=SUM(1,1)", "+cmd", "-danger", "@link", "normal", None, "", "a=b"]
    expected = ["'=SUM(1,1)", "'+cmd", "'-danger", "'@link", "normal", None, "", "a=b"]
    assert _apply(spark, display.spreadsheet_text, text) == expected


def test_labels_and_codes_without_one(spark):
    assert len(CATEGORY_LABELS) == 73
    assert all("_" not in text for text in CATEGORY_LABELS.values())
    named = _apply(spark, lambda c: label(c, SEGMENT_LABELS, "segmentos"), ["C_LOW_VALUE", "UNKNOWN"])
    assert named == ["C · Bajo valor", "Sin categoría conocida"]
    with pytest.raises(Exception, match="Faltan traducciones de categorías: new_code"):
        _apply(spark, lambda c: label(c, CATEGORY_LABELS, "categorías"), ["home", "new_code"])
    codes = spark.createDataFrame([("home",), ("new_code",), (None,), ("new_code",)], "code string")
    assert sorted(r.code for r in unmapped(codes, "code", CATEGORY_LABELS).collect()) == ["Sin datos", "new_code"]
