"""The document index: one Parquet table of documents and unit vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.functions.vectors import l2_normalise
from weekloom.schemas import VECTOR_INDEX
from weekloom.sources.tables import overwrite_table, read_table


def index_rows(documents: DataFrame) -> DataFrame:
    """Documents (STORE_NBR, WEEK_START, SUMMARY, VECTOR) as index rows."""
    return documents.select(
        F.col("STORE_NBR").cast("bigint").alias("store_nbr"),
        F.col("WEEK_START").cast("string").alias("week_start"),
        F.col("SUMMARY").alias("text"),
        l2_normalise(F.col("VECTOR")).cast("array<float>").alias("vector"),
    )


def write_index(documents: DataFrame, path: str) -> int:
    return overwrite_table(index_rows(documents), path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, VECTOR_INDEX)
