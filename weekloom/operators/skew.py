"""Salting for joins whose left side has a few very frequent keys.

AQE splits a skewed shuffle partition by its bytes, which misses copies that
compress well; this counts rows. Exact: no row is dropped, capped or sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 10_000_000
SALTS = 64
SPREAD = 8
#: Values that a frequency sketch follows. It surely has every value with more than 7 rows in 16,384.
TRACKED = 10_000


def hot_values(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Values of ``key`` (NULL too) with more than ``hot_rows`` rows.

    At most rows / hot_rows values, so the list may be broadcast.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_N"))
    return counts.where(F.col("_N") > hot_rows).select(F.col(key).alias("_HOT"), F.lit(True).alias("_IS_HOT"))


def frequency_sketch(key: str) -> Column:
    """An aggregate that follows the most frequent values of ``key`` (NULL too) in bounded memory; sketches can be combined."""
    return F.expr(f"approx_top_k_accumulate({key}, {TRACKED})")


def hot_in_sketches(sketches: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """As ``hot_values``, from the column SKETCH of one or more parts of a table: no row of it is read.

    Only how rows are spread depends on it, never a result, so counts may be off within the sketch's bounds.
    At most TRACKED values.
    """
    combined = sketches.agg(F.expr(f"approx_top_k_combine(SKETCH, {TRACKED})").alias("ALL"))
    values = combined.select(F.explode(F.expr(f"approx_top_k_estimate(ALL, {TRACKED})")).alias("V"))
    return values.where(F.col("V.count") > hot_rows).select(F.col("V.item").alias("_HOT"), F.lit(True).alias("_IS_HOT"))


def salt_rows(df: DataFrame, key: str, hot: DataFrame, salts: int = SALTS) -> DataFrame:
    """Add SALT: rows of hot values are spread by input partition, others get 0.

    The input partition, unlike a row number or a hash of the row, splits exact
    copies and is the same when a lost task runs again.
    """
    flagged = _flagged(df, key, hot)
    spread = F.pmod(F.spark_partition_id(), F.lit(salts))
    return flagged.withColumn("SALT", F.when(F.col("_IS_HOT"), spread).otherwise(F.lit(0))).drop("_IS_HOT")


def repeat_rows(df: DataFrame, key: str, hot: DataFrame, salts: int = SALTS) -> DataFrame:
    """The other side: rows of hot values once per salt, others with salt 0."""
    last = F.when(F.col("_IS_HOT"), F.lit(salts - 1)).otherwise(F.lit(0))
    return _flagged(df, key, hot).withColumn("SALT", F.explode(F.sequence(F.lit(0), last))).drop("_IS_HOT")


def spread_join(left: DataFrame, right: DataFrame, key: str, by: list[str], salts: int = SPREAD) -> DataFrame:
    """Left join on ``key`` with each value's rows, NULL too, spread by the columns ``by``.

    For a right side with one row per value, which is repeated ``salts`` times.
    """
    spread = left.withColumn("_SALT", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))
    repeated = right.withColumn("_SALT", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(repeated, [key, "_SALT"], "left").drop("_SALT")


def _flagged(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    same: Column = df[key].eqNullSafe(hot["_HOT"])
    return df.join(F.broadcast(hot), same, "left").drop("_HOT")
