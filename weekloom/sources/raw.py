"""Raw layer: every CSV column is text, headers are upper-cased."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from weekloom.fixed_values import NA_TOKENS, RAW_FILES
from weekloom.sources.records import records


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.upper() for name in df.columns])


def blank_missing(df: DataFrame) -> DataFrame:
    """Replace the missing-value tokens by NULL in every text column."""
    return df.select(*[
        F.when(~F.col(name).isin(NA_TOKENS), F.col(name)).alias(name) if kind == "string" else F.col(name)
        for name, kind in df.dtypes
    ])


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """One CSV with a header, all columns text, missing tokens as NULL.

    Quoted fields may hold line breaks; a large file is read by many tasks all the same. Short
    rows are padded with NULL; a row with more fields than the header stops every reading,
    whatever columns it asks for: of a row with another number of fields the parser keeps the
    record, whose separators outside quotes are counted. Records with too few separators for that in
    all are not parsed for this check.
    """
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    names = spark.read.options(header=True, inferSchema=False, **options).csv(path).columns
    kept = "_record"
    while kept in {name.lower() for name in names}:
        kept += "_"
    many = f"{kept}_many"
    while many in {name.lower() for name in names}:
        many += "_"
    schema = StructType([StructField(name, StringType()) for name in [*names, kept]])
    parsed = F.from_csv("record", _ddl(schema), options | {"columnNameOfCorruptRecord": kept, "mode": "PERMISSIVE"})
    commas = F.octet_length("record") - F.octet_length(F.replace(F.col("record"), F.lit(","), F.lit("")))
    rows = records(spark, path).select(parsed.alias("row"), (commas >= len(names)).alias(many)).select("row.*", many)
    separators = F.regexp_count(F.regexp_replace(F.col(kept), '"[^"]*"', ""), F.lit(","))
    message = F.lit(f"{path}: a row has more than {len(names)} fields")
    checked = F.when(F.col(many) & (separators >= len(names)), F.raise_error(message)).otherwise(F.lit(True))
    return blank_missing(upper_columns(rows.where(checked).drop(kept, many)))


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{field.name.replace('`', '``')}` string" for field in schema)


def load_raw(
    spark: SparkSession, folder: str, out_dir: str, files: Mapping[str, str] = RAW_FILES
) -> dict[str, int]:
    """Write each CSV of ``folder`` as a raw table; returns rows per table.

    The row count rides along with the write (``observe``), so no file is read
    twice. A missing or unreadable file stops the load.
    """
    counts = {}
    for file_name, table in files.items():
        seen = Observation(f"rows_{table}")
        frame = read_csv_text(spark, f"{folder.rstrip('/')}/{file_name}")
        (frame.observe(seen, F.count(F.lit(1)).alias("rows"))
              .write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{table}"))
        counts[table] = seen.get["rows"]
    return counts


def read_raw(spark: SparkSession, out_dir: str, files: Mapping[str, str] = RAW_FILES) -> dict[str, DataFrame]:
    return {table: spark.read.parquet(f"{out_dir.rstrip('/')}/{table}") for table in files.values()}
