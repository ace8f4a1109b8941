"""Rolling-origin comparison of all models, stored as two result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom import schemas
from weekloom.fixed_values import GBT_MODEL, KEYS, NAIVE_MODEL, TEST_WEEKS
from weekloom.operators import global_model, series_models
from weekloom.operators.global_model import Boosting
from weekloom.operators.scoring import (
    actual_rows, attach_predictions, backtest_rows, naive_prediction, score_models, test_weeks, top_series,
)
from weekloom.session import scratch_path
from weekloom.sources.raw import upper_columns
from weekloom.sources.tables import overwrite_table, read_table

MODEL_COLUMNS = {
    NAIVE_MODEL: "PRED_NAIVE52", "arima_fourier": "PRED_ARIMA", "trend_season": "PRED_TREND", GBT_MODEL: "PRED_GBT",
}


def run_backtest(
    spark: SparkSession, features: DataFrame, out: str, size: Boosting = Boosting(), n_weeks: int = TEST_WEEKS
) -> tuple[DataFrame, DataFrame]:
    """Write and return MODEL_RESULTS and BACKTEST_PREDICTIONS.

    ``features`` should be a stored table: every model reads it again.
    """
    actuals = actual_rows(features)
    weeks = test_weeks(actuals, n_weeks)
    tested = backtest_rows(actuals, weeks, top_series(actuals)).select(
        *KEYS, "SALES", "IS_TOP", naive_prediction().alias("PRED_NAIVE52")
    )
    arima = series_models.backtest_arima(actuals, weeks).withColumnRenamed("PRED", "PRED_ARIMA")
    trend = series_models.backtest_trend_season(actuals, weeks).withColumnRenamed("PRED", "PRED_TREND")
    rows_path = scratch_path(spark, "model-rows")  # every origin reads the rows again
    overwrite_table(global_model.model_rows(features).drop("INPUTS"), rows_path)
    boosted = global_model.backtest(read_table(spark, rows_path), size, n_weeks)
    for predictions, column in [(arima, "PRED_ARIMA"), (trend, "PRED_TREND"), (boosted, "PRED_GBT")]:
        tested = attach_predictions(tested, predictions, column)

    predictions_path, results_path = f"{out}/ANALYTICS/BACKTEST_PREDICTIONS", f"{out}/ANALYTICS/MODEL_RESULTS"
    overwrite_table(upper_columns(tested), predictions_path)
    predictions = read_table(spark, predictions_path)
    scores = score_models(predictions, MODEL_COLUMNS).withColumn("N", F.col("N").cast("bigint"))
    overwrite_table(upper_columns(scores), results_path)
    return read_table(spark, results_path, schemas.MODEL_RESULTS), predictions
