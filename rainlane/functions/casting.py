"""Casts that give NULL on bad text in every ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sign, whole digits, decimal point, fraction digits.
_DECIMAL_TEXT = r"^\s*([+-]?)(\d*)\.\d*\s*$"


def lenient_date(column: Column | str) -> Column:
    return _col(column).try_cast("date")


def lenient_int(column: Column | str) -> Column:
    """Text to int; decimal text is truncated ("12.0" -> 12), other text gives NULL.

    Extracts of nullable integer columns carry "12.0", which a plain
    ``try_cast`` would lose. The regular expression runs only where the
    direct cast failed.
    """
    text = _col(column)
    truncated = F.regexp_replace(text, _DECIMAL_TEXT, "$10$2")
    return F.coalesce(text.try_cast("int"), truncated.try_cast("int"))


def rounded_int(column: Column | str) -> Column:
    """Round half up to the nearest whole number, as int."""
    return F.round(_col(column)).cast("int")


def known(column: Column | str) -> Column:
    """A double with NaN read as missing."""
    value = _col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
