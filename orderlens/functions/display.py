"""Text shown to readers: Brazilian number formats, dates, month names and a missing-value label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.functions.measures import finite

# Label for missing data and the month abbreviations, January first.
MISSING = "Sin datos"
MONTHS = ("ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic")


def _formatted(value: Column, pattern: str) -> Column:
    """Grouped with dots, decimals after a comma; halves round to even as the pattern rules say."""
    return F.translate(F.call_function("format_number", value, F.lit(pattern)), ",.", ".,")


def _shown(c: Column, text: Column) -> Column:
    return F.when(finite(c).isNotNull(), text).otherwise(MISSING)


def money_millions(c: Column) -> Column:
    text = _formatted(c.cast("double") / 1_000_000, "#,##0.0")
    return _shown(c, F.concat(F.lit("R$ "), text, F.lit(" M")))


def currency(c: Column) -> Column:
    return _shown(c, F.concat(F.lit("R$ "), _formatted(c.cast("double"), "#,##0.00")))


def whole_number(c: Column) -> Column:
    return _shown(c, _formatted(c.cast("double"), "#,##0"))


def two_decimals(c: Column) -> Column:
    return _shown(c, _formatted(c.cast("double"), "0.00"))


def day(c: Column) -> Column:
    """dd/MM/yyyy; text that is no date is shown as it is."""
    parsed = F.date_format(c.cast("string").try_cast("date"), "dd/MM/yyyy")
    return F.coalesce(parsed, c.cast("string"), F.lit(MISSING))


def month_label(c: Column) -> Column:
    names = F.array(*[F.lit(m) for m in MONTHS])
    return F.concat_ws(" ", F.element_at(names, F.month(c)), F.year(c).cast("string"))


def spreadsheet_text(c: Column) -> Column:
    """Text a spreadsheet would run as a formula gets a leading quote."""
    return F.when(c.rlike(r"^[=+\-@]"), F.concat(F.lit("'"), c)).otherwise(c)
