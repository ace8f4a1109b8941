"""Number formatting for the narrative text (half-even on the exact double)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousands(value: Column) -> Column:
    """``1234567.5`` -> ``1,234,568``; missing and infinite values by name."""
    return _named(value, F.format_number(value, 0), signed=True)


def one_decimal(value: Column) -> Column:
    return F.call_function("format_number", value, F.lit("0.0"))


def percent_change(new: Column, old: Column) -> Column:
    """NULL when the old value is missing or zero."""
    return F.when(old != 0, (new - old) / old * 100)


def ratio_percent_change(new: Column, old: Column) -> Column:
    """Unguarded form: a zero base gives +/-infinity, and NULL for 0 over 0."""
    grown_from_zero = (
        F.when(new > 0, F.lit(float("inf"))).when(new < 0, F.lit(float("-inf")))
    )
    return F.when(old == 0, grown_from_zero).when(old != 0, (new - old) / old * 100)


def direction(percent: Column) -> Column:
    """``up 3.2%`` / ``down 1.0%`` / ``n/a``."""
    size = F.abs(percent)
    word = F.when(percent >= 0, "up ").otherwise("down ")
    text = F.concat(word, _named(size, one_decimal(size)), F.lit("%"))
    return F.coalesce(text, F.lit("n/a"))


def _named(value: Column, formatted: Column, signed: bool = False) -> Column:
    infinite = F.lit(float("inf"))
    text = F.when(value == infinite, "inf")
    if signed:
        text = text.when(value == -infinite, "-inf").when(value.isNull(), "nan")
    return text.otherwise(formatted)
