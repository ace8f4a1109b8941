"""Table sinks and readers on Parquet folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weekloom.fixed_values import ROW_LIMIT
from weekloom.operators.skew import HOT_ROWS, frequency_sketch, hot_in_sketches

JSON_DECIMALS = 10
SKETCHES = "SKETCH struct<sketch: binary, maxItemsTracked: int, itemDataType: bigint, itemDataTypeDDL: string>"


def overwrite_table(df: DataFrame, path: str, partition: str | None = None) -> int:
    """Replace the whole table; returns the rows written."""
    return _write(df, path, "overwrite", partition)


def overwrite_tracked(df: DataFrame, path: str, key: str) -> int:
    """``overwrite_table`` that also keeps a sketch of the frequent values of ``key``, made by the write itself."""
    return _write_tracked(df, path, key, "overwrite")


def append_tracked(df: DataFrame, path: str, key: str) -> int:
    """Add rows to a tracked table; their sketch is added to the others."""
    return _write_tracked(df, path, key, "append")


def _write_tracked(df: DataFrame, path: str, key: str, mode: str) -> int:
    spark, seen = df.sparkSession, Observation("rows_tracked")
    df.observe(seen, F.count(F.lit(1)).alias("rows"), frequency_sketch(key).alias("sketch")).write.mode(mode).parquet(path)
    sketch = spark.createDataFrame([(seen.get["sketch"],)], SKETCHES)
    sketch.coalesce(1).write.mode(mode).parquet(_sketches(path))
    return seen.get["rows"]


def frequent_values(spark: SparkSession, path: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The hot values of a tracked table's key, from its sketches."""
    return hot_in_sketches(read_table(spark, _sketches(path), SKETCHES), hot_rows)


def _sketches(path: str) -> str:
    return f"{path.rstrip('/')}_FREQUENT"


def append_run(df: DataFrame, path: str) -> int:
    """Add one run's rows to a log, one folder per RUN_TS; returns the rows written.

    A run written again under its RUN_TS replaces what it wrote before, other runs stay: only the folders
    of the given runs are exchanged, when all rows are written. ``<path>_RUNS`` then notes the number of
    rows of each, so that ``run_status`` finds a run that was cut off. Without rows nothing changes.
    """
    seen = Observation("run_written")
    span = F.min("RUN_TS").alias("first"), F.max("RUN_TS").alias("last")
    _replace_runs(df.observe(seen, F.count(F.lit(1)).alias("rows"), *span), path)
    if seen.get["rows"]:
        stored = read_table(df.sparkSession, path, df.schema).where(F.col("RUN_TS").between(seen.get["first"], seen.get["last"]))
        _replace_runs(_rows_per_run(stored), f"{path.rstrip('/')}_RUNS")
    return seen.get["rows"]


def run_status(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """RUN_TS, N_ROWS found, N_NOTED and SETTLED (they are equal) of each run of a log."""
    found = _rows_per_run(read_table(spark, path, schema))
    noted = read_table(spark, f"{path.rstrip('/')}_RUNS", "N_ROWS bigint, RUN_TS string").withColumnRenamed("N_ROWS", "N_NOTED")
    return found.join(noted, "RUN_TS", "full").withColumn("SETTLED", F.col("N_ROWS").eqNullSafe(F.col("N_NOTED")))


def _rows_per_run(rows: DataFrame) -> DataFrame:
    return rows.groupBy("RUN_TS").agg(F.count(F.lit(1)).alias("N_ROWS"))


def _replace_runs(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("RUN_TS").parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a whole table was written at the path and its write was committed."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def latest_run(log: DataFrame) -> DataFrame:
    """Rows of the newest run. RUN_TS compares as text.

    On a log stored by RUN_TS the scalar subquery prunes to one folder.
    """
    newest = log.agg(F.max("RUN_TS")).scalar()
    return log.where(F.col("RUN_TS") == newest)


def weeks_of(rows: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Rows within the forecast weeks: cuts the history before a join on the week."""
    span = forecasts.agg(F.min("WEEK_START").alias("lo"), F.max("WEEK_START").alias("hi"))
    return rows.where(F.col("WEEK_START").between(span.select("lo").scalar(), span.select("hi").scalar()))


def rows_as_json(df: DataFrame, *order: Column, limit: int = ROW_LIMIT) -> DataFrame:
    """At most ``limit`` rows as JSON records: dates in ISO form, numbers to 10 decimals, NULLs kept."""
    ordered = df.orderBy(*order) if order else df
    shown = {
        **dict.fromkeys(("date", "timestamp", "timestamp_ntz"), lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS")),
        **dict.fromkeys(("double", "float"), lambda c: F.round(F.col(c).cast("double"), JSON_DECIMALS)),
    }
    fields = [shown.get(kind, F.col)(name).alias(name) for name, kind in df.dtypes]
    record = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return ordered.limit(limit).select(record.alias("ROW"))


def _write(df: DataFrame, path: str, mode: str, partition: str | None) -> int:
    seen = Observation("rows_written")
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return seen.get["rows"]
