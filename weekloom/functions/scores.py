"""Forecast error measures as aggregate expressions (use inside ``agg``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wape(actual: Column, forecast: Column) -> Column:
    """Sum of absolute errors over sum of absolute actuals; NULL if those are 0."""
    return F.try_divide(F.sum(F.abs(actual - forecast)), F.sum(F.abs(actual)))


def rmse(actual: Column, forecast: Column) -> Column:
    error = actual - forecast
    return F.sqrt(F.avg(error * error))


def to_log_scale(sales: Column) -> Column:
    return F.log1p(F.greatest(sales, F.lit(0.0)))


def from_log_scale(value: Column) -> Column:
    return F.greatest(F.expm1(value), F.lit(0.0))
