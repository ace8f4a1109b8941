"""Calendar expressions. Weeks start on Monday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(day: Column) -> Column:
    return F.trunc(day, "week")


def iso_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")
