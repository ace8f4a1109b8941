"""Backtest rows, model scores, comparison table and the accuracy gate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.fixed_values import GATE_THRESHOLD, KEYS, NAIVE_MODEL, SERIES, TEST_WEEKS, TOP_SERIES
from weekloom.functions.dates import iso_text
from weekloom.functions.scores import rmse, wape
from weekloom.functions.text import one_decimal


def actual_rows(features: DataFrame) -> DataFrame:
    return features.where(F.col("IS_FUTURE") == 0)


def future_rows(features: DataFrame) -> DataFrame:
    return features.where(F.col("IS_FUTURE") == 1)


def test_weeks(rows: DataFrame, n: int = TEST_WEEKS) -> DataFrame:
    """The newest ``n`` distinct weeks."""
    return rows.select("WEEK_START").distinct().orderBy(F.desc("WEEK_START")).limit(n)


test_weeks.__test__ = False  # not a pytest case


def top_series(rows: DataFrame, n: int = TOP_SERIES) -> DataFrame:
    """The ``n`` series with the largest total sales; ties by store, family."""
    totals = rows.groupBy(*SERIES).agg(F.sum("SALES").alias("TOTAL_SALES"))
    totals = totals.withColumn("TOTAL_SALES", F.round("TOTAL_SALES", 2))
    return totals.orderBy(F.desc_nulls_last("TOTAL_SALES"), *SERIES).limit(n)


def backtest_rows(rows: DataFrame, weeks: DataFrame | None = None, top: DataFrame | None = None) -> DataFrame:
    """Rows of the test weeks with IS_TOP (series among the biggest).

    Both side tables hold at most a handful of rows, by their LIMIT.
    """
    weeks = test_weeks(rows) if weeks is None else weeks
    top = top_series(rows) if top is None else top
    flags = top.select(*SERIES, F.lit(True).alias("IS_TOP"))
    tested = rows.join(F.broadcast(weeks), "WEEK_START", "left_semi").join(F.broadcast(flags), SERIES, "left")
    return tested.withColumn("IS_TOP", F.coalesce("IS_TOP", F.lit(False)))


def naive_prediction() -> Column:
    """Sales of the same week last year; 0 when unknown."""
    return F.coalesce("SALES_LAG_52", F.lit(0.0))


def attach_predictions(tested: DataFrame, predictions: DataFrame, column: str) -> DataFrame:
    """Add (or replace) one model's predictions by series and week."""
    return tested.drop(column).join(predictions.select(*KEYS, column), KEYS, "left")


def score_models(tested: DataFrame, models: Mapping[str, str]) -> DataFrame:
    """MODEL, SCOPE, N, WAPE, RMSE for ``models`` = {model name: column}.

    Scope 'all' appears only for models that predicted every row; 'top10' scores
    the rows they did predict.
    """
    entries = [F.struct(F.lit(m).alias("MODEL"), F.col(c).alias("PRED")) for m, c in models.items()]
    long = tested.select("SALES", "IS_TOP", F.explode(F.array(*entries)).alias("E")).select("SALES", "IS_TOP", "E.*")

    def scored(scope: str, rows: Column) -> list[Column]:
        used = rows & F.col("PRED").isNotNull()
        sales, pred = F.when(used, F.col("SALES")), F.when(used, F.col("PRED"))
        return [
            F.count_if(used).alias(f"{scope}_N"),
            wape(sales, pred).alias(f"{scope}_WAPE"),
            rmse(sales, pred).alias(f"{scope}_RMSE"),
        ]

    per_model = long.groupBy("MODEL").agg(
        F.count(F.lit(1)).alias("ROWS"), *scored("all", F.lit(True)), *scored("top10", F.col("IS_TOP"))
    )
    scopes = [
        F.struct(
            F.lit(s).alias("SCOPE"), F.col(f"{s}_N").alias("N"),
            F.col(f"{s}_WAPE").alias("WAPE"), F.col(f"{s}_RMSE").alias("RMSE"),
        )
        for s in ("all", "top10")
    ]
    rows = per_model.select("MODEL", "ROWS", F.explode(F.array(*scopes)).alias("S")).select("MODEL", "ROWS", "S.*")
    return rows.where((F.col("SCOPE") == "top10") | (F.col("N") == F.col("ROWS"))).drop("ROWS")


def compare_models(results: DataFrame, base_model: str = NAIVE_MODEL) -> DataFrame:
    """WAPE per model and scope, with the top-10 gain over the base model."""
    wide = results.groupBy("MODEL").pivot("SCOPE", ["all", "top10"]).agg(F.round(F.first("WAPE"), 4))
    wide = wide.select("MODEL", F.col("all").alias("ALL_SERIES"), F.col("top10").alias("TOP10"))
    base_row = results.where((F.col("MODEL") == base_model) & (F.col("SCOPE") == "top10"))
    base = base_row.agg(F.round(F.first("WAPE"), 4)).scalar()
    gain = F.try_divide(base - F.col("TOP10"), base) * 100
    label = F.concat(one_decimal(gain), F.lit("%"))
    return wide.withColumn("IMPROVEMENT_VS_NAIVE_TOP10", F.coalesce(label, F.lit("nan%")))


def rank_models(results: DataFrame, scope: str = "top10") -> DataFrame:
    return results.where(F.col("SCOPE") == scope).select("MODEL", "WAPE").orderBy(
        F.asc_nulls_last("WAPE"), "MODEL"
    )


def holdout_rows(actuals: DataFrame, newest: Column | None = None) -> DataFrame:
    """Rows of the newest actual week (or of the week the caller already knows)."""
    newest = actuals.agg(F.max("WEEK_START")).scalar() if newest is None else newest
    return actuals.where(F.col("WEEK_START") == newest)


def gate_log(
    scored: DataFrame, column: str, model: str, run_ts: str, threshold: float = GATE_THRESHOLD
) -> DataFrame:
    """One accuracy-log row for holdout rows with a prediction ``column``."""
    error = wape(F.col("SALES"), F.col(column))
    return scored.agg(
        F.lit(run_ts).alias("RUN_TS"),
        F.lit(model).alias("MODEL"),
        iso_text(F.max("WEEK_START")).alias("EVAL_WEEK"),
        error.alias("WAPE"),
        F.count(F.lit(1)).alias("N_SERIES"),
        F.lit(float(threshold)).alias("THRESHOLD"),
        F.coalesce(error <= F.lit(float(threshold)), F.lit(False)).alias("PASSED"),
    )


def forecast_rows(predicted: DataFrame, column: str, model: str, run_ts: str) -> DataFrame:
    """FORECASTS rows of one run."""
    return predicted.select(
        *KEYS, F.col(column).alias("FORECAST"), F.lit(model).alias("MODEL"), F.lit(run_ts).alias("RUN_TS")
    )
