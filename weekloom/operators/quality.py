"""Data-quality checks over the staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(daily: DataFrame, weekly: DataFrame) -> DataFrame:
    """Sales total of both grains in one row, summed as decimals and rounded once."""
    def total(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.round(F.sum(F.col("SALES").cast("decimal(28,6)"))).cast("double").alias(name))

    weekly_total = total(weekly, "WEEKLY_TOTAL")
    return total(daily, "DAILY_TOTAL").select("DAILY_TOTAL", weekly_total.scalar().alias("WEEKLY_TOTAL"))


def unparsed_dates(daily: DataFrame) -> DataFrame:
    return daily.agg(F.count_if(F.col("DATE").isNull()).alias("UNPARSED_DATES"))


def oil_gaps(oil: DataFrame) -> DataFrame:
    return oil.agg(F.count_if(F.col("OIL_PRICE").isNull()).alias("OIL_GAPS"))


def partial_weeks(weekly: DataFrame) -> DataFrame:
    """Per week: how many series have fewer than seven daily rows."""
    return weekly.groupBy("WEEK_START").agg(
        F.count_if(F.col("DAYS_IN_WEEK") < 7).alias("PARTIAL_SERIES"), F.count(F.lit(1)).alias("SERIES")
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("N_ROWS")).where(F.col("N_ROWS") > 1)


def assert_unique(df: DataFrame, keys: list[str], name: str) -> None:
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"{name} has duplicate keys {keys}")


def conflicting_store_columns(enriched: DataFrame, columns: list[str]) -> DataFrame:
    """Stores whose attributes differ between rows (any_value would be unsafe)."""
    different = [(F.min(c) != F.max(c)) | ((F.count(c) > 0) & (F.count(c) < F.count(F.lit(1)))) for c in columns]
    flagged = enriched.groupBy("STORE_NBR").agg(*[d.alias(c) for d, c in zip(different, columns)])
    anywhere = F.greatest(F.lit(False), *[F.coalesce(F.col(c), F.lit(False)) for c in columns])
    return flagged.where(anywhere).select("STORE_NBR")


def weekly_preview(weekly: DataFrame, rows: int = 20) -> DataFrame:
    return weekly.orderBy("STORE_NBR", "FAMILY", "WEEK_START").limit(rows)
