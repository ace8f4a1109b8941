"""Exploratory reports and the business questions about the latest forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.fixed_values import KEYS, SERIES
from weekloom.functions.text import percent_change
from weekloom.operators.features import series_tail
from weekloom.sources.tables import latest_run, weeks_of


def _sum(column: str) -> Column:
    """Sum rounded well below a cent, so ranks do not depend on summation order."""
    return F.round(F.sum(column), 6)


# --- exploratory reports over the trimmed weekly table ------------------------

def weekly_total(weekly: DataFrame) -> DataFrame:
    return weekly.groupBy("WEEK_START").agg(F.sum("SALES").alias("SALES"))


def top_families(weekly: DataFrame, n: int = 10) -> DataFrame:
    """The n families with the largest sales, smallest of them first."""
    totals = weekly.groupBy("FAMILY").agg(_sum("SALES").alias("SALES"))
    return totals.orderBy(F.desc_nulls_last("SALES"), "FAMILY").limit(n).orderBy("SALES", F.desc("FAMILY"))


def seasonality(weekly: DataFrame) -> DataFrame:
    return weekly.groupBy(F.weekofyear("WEEK_START").alias("WEEK_OF_YEAR")).agg(F.avg("SALES").alias("AVG_SALES"))


def sales_by_flag(weekly: DataFrame, column: str, flag: str) -> DataFrame:
    """Average sales of weeks with and without a positive ``column``."""
    positive = F.coalesce(F.col(column) > 0, F.lit(False))
    return weekly.groupBy(positive.alias(flag)).agg(F.avg("SALES").alias("AVG_SALES"))


def biggest_series_history(actuals: DataFrame, top: DataFrame, weeks: int = 30) -> DataFrame:
    """The newest weeks of the biggest series."""
    biggest = top.orderBy(F.desc("TOTAL_SALES"), *SERIES).limit(1).select(*SERIES)
    rows = actuals.join(F.broadcast(biggest), SERIES, "left_semi")
    return series_tail(rows.select(*KEYS, "SALES"), weeks)


# --- business questions -------------------------------------------------------

def top_stores(forecasts: DataFrame, n: int = 5) -> DataFrame:
    totals = latest_run(forecasts).groupBy("STORE_NBR").agg(_sum("FORECAST").alias("TOTAL_FORECAST"))
    return totals.orderBy(F.desc_nulls_first("TOTAL_FORECAST"), "STORE_NBR").limit(n)


def top_family(forecasts: DataFrame, n: int = 1) -> DataFrame:
    totals = latest_run(forecasts).groupBy("FAMILY").agg(_sum("FORECAST").alias("TOTAL_FORECAST"))
    return totals.orderBy(F.desc_nulls_first("TOTAL_FORECAST"), "FAMILY").limit(n)


def newest_check(accuracy_log: DataFrame) -> DataFrame:
    """The newest accuracy-log row."""
    return accuracy_log.orderBy(F.desc("RUN_TS"), "MODEL").limit(1)


def best_model(results: DataFrame, scope: str = "top10") -> DataFrame:
    ranked = results.where(F.col("SCOPE") == scope).orderBy(F.asc_nulls_last("WAPE"), "MODEL")
    return ranked.limit(1).select("MODEL", "WAPE")


def forecast_count(forecasts: DataFrame) -> DataFrame:
    return latest_run(forecasts).agg(F.count(F.lit(1)).alias("N_SERIES"))


def city_with_most_stores(stores: DataFrame) -> DataFrame:
    counts = stores.groupBy("CITY").agg(F.count(F.lit(1)).alias("N_STORES"))
    return counts.orderBy(F.desc("N_STORES"), F.asc_nulls_last("CITY")).limit(1)


def forecast_total(forecasts: DataFrame) -> DataFrame:
    return latest_run(forecasts).agg(_sum("FORECAST").alias("TOTAL_FORECAST"))


def _against_last_week(forecasts: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """Totals of forecast and last week per ``key``, over matching rows."""
    latest = latest_run(forecasts)
    joined = latest.join(weeks_of(features, latest).select(*KEYS, "SALES_LAG_1"), KEYS)
    return joined.groupBy(key).agg(_sum("FORECAST").alias("TOTAL_FORECAST"), _sum("SALES_LAG_1").alias("LAST_WEEK"))


def store_declines(forecasts: DataFrame, features: DataFrame, n: int = 3) -> DataFrame:
    """Stores with the largest relative decline of totals against last week."""
    totals = _against_last_week(forecasts, features, "STORE_NBR")
    change = F.try_divide(F.col("TOTAL_FORECAST") - F.col("LAST_WEEK"), F.col("LAST_WEEK"))
    ranked = totals.withColumn("CHANGE_RATIO", F.round(change, 9))
    return ranked.orderBy(F.asc_nulls_last("CHANGE_RATIO"), "STORE_NBR").limit(n)


def family_change(forecasts: DataFrame, features: DataFrame) -> DataFrame:
    """The family with the largest forecast and its change against last week."""
    totals = _against_last_week(forecasts, features, "FAMILY")
    largest = totals.orderBy(F.desc_nulls_last("TOTAL_FORECAST"), "FAMILY").limit(1)
    return largest.withColumn("PCT_CHANGE", percent_change(F.col("TOTAL_FORECAST"), F.col("LAST_WEEK")))


def forecast_example(history: DataFrame, predictions: DataFrame, columns: list[str]) -> DataFrame:
    """The biggest series' newest weeks (biggest_series_history) beside every model's test-week predictions."""
    return history.join(predictions.select(*KEYS, *columns), KEYS, "left")
