"""Tolerant text-to-value casts: bad input becomes NULL, never an error or NaN."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from weekloom.fixed_values import ISO_DATE_PATTERN


def to_date(text: Column, formats: Sequence[str] = ()) -> Column:
    """ISO dates only, plus any extra ``formats`` asked for.

    The pattern check comes first because a plain cast also accepts '2013'.
    """
    iso = F.when(text.rlike(ISO_DATE_PATTERN), text.try_cast("date"))
    return F.coalesce(iso, *[F.to_date(F.try_to_timestamp(text, F.lit(f))) for f in formats])


def to_long(text: Column) -> Column:
    """Whole number; a decimal text rounds half up, as NUMBER(38,0) does."""
    return text.try_cast("decimal(38,0)").try_cast("bigint")


def to_double(value: Column) -> Column:
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)
