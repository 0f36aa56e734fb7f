"""Text to typed values. A value that does not parse becomes NULL; nothing raises.

The rules follow the SQL engine whose results we match, which differ from a bare Spark cast in four
places: ``'1.5'`` is the integer 2, ``'1d'`` is no number, ``'2018'`` and ``'2018-01'`` are no
timestamps, and digits outside ASCII are no digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A day, alone or followed by at least hours and minutes; no trailing blanks.
_TIMESTAMP_TEXT = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9](.*\S)?)?$"
# Java reads "1d" and "1f" as numbers.
_JAVA_SUFFIX = r"[0-9.][dDfF]\s*$"


def blank_to_null(c: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def lower_text(c: Column) -> Column:
    return F.lower(blank_to_null(c))


def upper_text(c: Column) -> Column:
    return F.upper(blank_to_null(c))


def _ascii(c: Column) -> Column:
    return F.length(c) == F.octet_length(c)


def parse_int(c: Column) -> Column:
    """Integer, halves rounded away from zero; exponents and fractions are allowed in the text."""
    wide = F.when(_ascii(c), c.try_cast("decimal(38,6)"))
    return F.round(wide).try_cast("int")


def parse_decimal(c: Column, precision: int = 18, scale: int = 2) -> Column:
    return F.when(_ascii(c), c.try_cast(f"decimal({precision},{scale})"))


def parse_double(c: Column) -> Column:
    return F.when(~c.rlike(_JAVA_SUFFIX), c.try_cast("double"))


def parse_timestamp(c: Column) -> Column:
    """Timestamp without zone, so a day boundary never depends on the session zone."""
    return F.when(c.rlike(_TIMESTAMP_TEXT), c.try_cast("timestamp_ntz"))
