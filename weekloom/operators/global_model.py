"""One gradient-boosted model over all series."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.fixed_values import (
    COLUMN_SAMPLE, GBT_MODEL, KEYS, LEARNING_RATE, MODEL_INPUTS, ROW_SAMPLE, TEST_WEEKS, TREE_DEPTH, TREES,
)
from weekloom.functions.scores import from_log_scale, to_log_scale
from weekloom.operators import boosting
from weekloom.operators.features import attach_codes, category_codes
from weekloom.operators.scoring import (
    actual_rows, forecast_rows, future_rows, gate_log, holdout_rows, test_weeks,
)
from weekloom.session import scratch_path, shuffles_dropped
from weekloom.sources.tables import finished

PARALLEL_FITS = 4
ALWAYS_KNOWN = {"STORE_NBR", "WEEK_OF_YEAR", "MONTH", "FAMILY_CODE", "STORE_TYPE_CODE"}
#: Columns with each input's bin (-1: missing), from which trees are grown.
BIN_COLUMNS = [f"IN_{c}" for c in MODEL_INPUTS]


@dataclass(frozen=True)
class Boosting:
    """Training size. The defaults are the production settings."""

    trees: int = TREES
    depth: int = TREE_DEPTH
    rate: float = LEARNING_RATE
    rows: float = ROW_SAMPLE
    columns: str = COLUMN_SAMPLE
    bins: int = 256
    seed: int = 7


def model_rows(features: DataFrame, bins: int = 256, n_weeks: int = TEST_WEEKS) -> DataFrame:
    """Keys, label, the model vector and the bins it is made of, binned once for all fits.

    Each input becomes the number of its bin; bins are quantiles of the trainable rows before the newest
    ``n_weeks`` weeks (of all trainable rows, if there are no earlier ones), so no backtest sees its own weeks.
    An input that can be missing enters twice, with missing values below all bins and above all of them. A
    split on either copy sends them left or right, whichever fits better, as a learned default direction does.
    Category codes enter as numbers.
    """
    coded = features
    for column, name in [("FAMILY", "FAMILY_CODE"), ("STORE_TYPE", "STORE_TYPE_CODE")]:
        coded = attach_codes(coded, column, category_codes(features, column), name)
    wide = coded.select(
        *KEYS, "SALES", "IS_FUTURE", "SALES_LAG_52", to_log_scale(F.col("SALES")).alias("LABEL"),
        *(F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"X_{c}") for c in MODEL_INPUTS),
    )
    inputs = [f"X_{c}" for c in MODEL_INPUTS]
    splits = bin_edges(wide, inputs, bins, n_weeks)
    numbers = [f"BIN_{c}" for c in MODEL_INPUTS]
    binned = Bucketizer(inputCols=inputs, outputCols=numbers, splitsArray=splits, handleInvalid="keep").transform(wide)
    missing = {c: F.col(f"BIN_{c}") == len(edges) - 1 for c, edges in zip(MODEL_INPUTS, splits)}
    above = {c: (F.col(f"BIN_{c}") / (len(edges) - 1)).alias(f"HIGH_{c}") for c, edges in zip(MODEL_INPUTS, splits)}
    below = [F.when(missing[c], -1.0).otherwise(F.col(f"BIN_{c}")).alias(f"LOW_{c}") for c in MODEL_INPUTS]
    places = [F.when(missing[c], -1).otherwise(F.col(f"BIN_{c}")).cast("smallint").alias(f"IN_{c}") for c in MODEL_INPUTS]
    twice = binned.select(*KEYS, "SALES", "IS_FUTURE", "SALES_LAG_52", "LABEL", *below, *(above[c] for c in nullable_inputs()), *places)
    names = [f"LOW_{c}" for c in MODEL_INPUTS] + [f"HIGH_{c}" for c in nullable_inputs()]
    vectors = VectorAssembler(inputCols=names, outputCol="INPUTS").transform(twice)
    return vectors.select(*KEYS, "SALES", "IS_FUTURE", "SALES_LAG_52", "LABEL", "INPUTS", *BIN_COLUMNS)


def nullable_inputs() -> list[str]:
    return [c for c in MODEL_INPUTS if c not in ALWAYS_KNOWN]


def bin_edges(wide: DataFrame, inputs: list[str], bins: int, n_weeks: int) -> list[list[float]]:
    """Splits of each input, from quantile sketches: at most ``bins`` bins, their ends open."""
    first_test = F.date_sub(actual_rows(wide).agg(F.max("WEEK_START")).scalar(), 7 * (n_weeks - 1))
    history = trainable(wide)
    shares = [i / bins for i in range(1, bins)]
    for rows in (history.where(F.col("WEEK_START") < first_test), history):
        found = rows.approxQuantile(inputs, shares, 0.25 / bins)
        if any(found):
            break
    return [[float("-inf"), *(sorted(set(edges)) or [0.0]), float("inf")] for edges in found]


def trainable(rows: DataFrame) -> DataFrame:
    """Actual rows that have last year's value."""
    return actual_rows(rows).where(F.col("SALES_LAG_52").isNotNull() & F.col("SALES").isNotNull())


def fit(train: DataFrame, size: Boosting = Boosting()) -> boosting.Model:
    """Fit on the log scale. The training rows are kept in memory for the boosting rounds."""
    share = 1.0 if size.columns == "all" else float(size.columns)
    upper = [MODEL_INPUTS.index(c) for c in nullable_inputs()]
    return boosting.fit(train, "LABEL", BIN_COLUMNS, upper, size.trees, size.depth, size.rate, size.rows, share, size.bins, size.seed)


def predict(model: boosting.Model, rows: DataFrame, column: str = "PRED_GBT") -> DataFrame:
    return rows.withColumn(column, from_log_scale(model.predicted(BIN_COLUMNS)))


def load(spark: SparkSession, path: str) -> boosting.Model:
    return boosting.Model.load(spark, path, len(MODEL_INPUTS))


def importance(spark: SparkSession, model: boosting.Model) -> DataFrame:
    """Input name and importance (of both copies, if there are two), ascending.

    At most one row per model input; its size does not depend on the data.
    """
    weights = model.gains([MODEL_INPUTS.index(c) for c in nullable_inputs()])
    rows = [(name, float(w)) for name, w in zip(MODEL_INPUTS + nullable_inputs(), weights)]
    table = spark.createDataFrame(rows, "FEATURE string, IMPORTANCE double")
    return table.groupBy("FEATURE").agg(F.sum("IMPORTANCE").alias("IMPORTANCE")).orderBy("IMPORTANCE", "FEATURE")


def backtest(
    rows: DataFrame, size: Boosting = Boosting(), n_weeks: int = TEST_WEEKS, folder: str | None = None
) -> DataFrame:
    """One-week-ahead predictions for the newest weeks, refitted per week.

    At most ``n_weeks`` dates, several at a time, each in a scheduler pool of its own; every fit and
    prediction is a distributed job on rows strictly before the predicted week. ``rows`` should be stored.
    Each origin's model and predictions are stored under ``folder``; a sweep that was cut off goes on from
    the finished ones. A folder belongs to one state of the data; other sizes have folders of their own.
    """
    spark = rows.sparkSession
    actuals = actual_rows(rows)
    weeks = sorted(r[0] for r in test_weeks(actuals, n_weeks).collect())
    if not weeks:
        raise ValueError("no weeks to backtest")
    base = f"{(folder or scratch_path(spark, 'sweep')).rstrip('/')}/{'-'.join(str(v) for v in vars(size).values())}"

    def one(week) -> str:
        out = f"{base}/predictions/{week}"
        if not finished(spark, out):
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"origin-{week}")
            try:
                model = fit(trainable(rows).where(F.col("WEEK_START") < F.lit(week)), size)
                model.save(spark, f"{base}/models/{week}")
                predicted = predict(model, actuals.where(F.col("WEEK_START") == F.lit(week)))
                predicted.select(*KEYS, "SALES", "PRED_GBT").write.mode("overwrite").parquet(out)
            finally:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
        return out

    with shuffles_dropped(spark), ThreadPoolExecutor(PARALLEL_FITS) as pool:  # each fit deals out the rows anew
        parts = list(pool.map(one, weeks))
    return spark.read.parquet(*parts)


def gate(rows: DataFrame, run_ts: str, threshold: float, size: Boosting = Boosting()) -> DataFrame:
    """Accuracy-log row: train on all but the newest week, score that week."""
    actuals = actual_rows(rows)
    newest = actuals.agg(F.max("WEEK_START")).scalar()
    model = fit(trainable(rows).where(F.col("WEEK_START") < newest), size)
    return gate_log(predict(model, holdout_rows(actuals)), "PRED_GBT", GBT_MODEL, run_ts, threshold)


def forecast(
    rows: DataFrame, run_ts: str, size: Boosting = Boosting(), model: boosting.Model | None = None
) -> DataFrame:
    """FORECASTS rows for the next week, by ``model`` or one fitted here; fails when there is nothing to forecast."""
    future = future_rows(rows)
    if future.isEmpty():
        raise ValueError("no future rows in the features")
    return forecast_rows(predict(model or fit(trainable(rows), size), future), "PRED_GBT", GBT_MODEL, run_ts)
