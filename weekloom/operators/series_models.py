"""Per-series regressions, fitted for all series in parallel.

A series of the weekly table has at most one row per week, whatever the number of
daily rows behind it. Rows are spread by series and ordered by week; a task fits a
number of its series together, which share what depends on the weeks alone.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekloom import fixed_values
from weekloom.fixed_values import FOURIER_ORDER, KEYS, SEASON_WEEKS, SERIES
from weekloom.operators import fourier_arima, trend_season
from weekloom.operators.scoring import test_weeks

for module in (sys.modules[__name__], fourier_arima, trend_season, fixed_values):
    cloudpickle.register_pickle_by_value(module)  # executors need not have this package

LEAST_ARIMA = 2 * fourier_arima.LONG_AR + 2 * FOURIER_ORDER + 4
REGRESSORS = ["PROMO_ITEMS", "HOLIDAY_DAYS"]
#: Series fitted together, and the weeks they need; shorter ones are fitted alone.
TOGETHER, LEAST_TOGETHER = 128, 2 * SEASON_WEEKS
RESULT = "STORE_NBR bigint, FAMILY string, WEEK_START date, PRED double, ERROR string"


def backtest_arima(rows: DataFrame, weeks: DataFrame | None = None) -> DataFrame:
    """ARIMA(1,1,1) errors with yearly Fourier terms by exact likelihood, one week ahead."""
    return _backtest(rows, weeks, _arima, _arima_together, LEAST_ARIMA)


def backtest_trend_season(rows: DataFrame, weeks: DataFrame | None = None) -> DataFrame:
    """Piecewise linear trend, yearly season, promotions and holidays, one week ahead."""
    return _backtest(rows, weeks, trend_season.forecasts, trend_season.forecasts_together, 2)


def check_fits(rows: DataFrame, weeks: DataFrame | None = None) -> DataFrame:
    """Per series, the newest test week and what the fits of all weeks before the tested ones hold to.

    ARIMA_EXACT: the likelihood is that of the covariance matrix; ARIMA_BEST: it isn't below the two-stage
    estimate's; TREND_OPTIMAL: the slope changes meet the optimality conditions. NULL for too short a history.
    """
    weeks = test_weeks(rows) if weeks is None else weeks
    span = weeks.agg(F.min("WEEK_START").alias("FIRST"), F.max("WEEK_START").alias("LAST"))
    first, last = (span.select(c).scalar() for c in ("FIRST", "LAST"))
    history = rows.where(F.col("WEEK_START") < first).withColumn("IS_TEST", F.lit(0))

    def check(some: list[Series]) -> pa.RecordBatch:
        found: dict[int, tuple[bool | None, ...]] = {}
        for alike in _alike(some):
            if len(alike) > 1:
                y, regressors = (np.array([getattr(some[i], c) for i in alike]) for c in ("sales", "regressors"))
                try:
                    results = *fourier_arima.optima(y, _season(y.shape[1])), trend_season.optima(y, some[alike[0]].days, regressors)
                except (ValueError, np.linalg.LinAlgError):
                    continue  # each is checked alone
                found |= {i: tuple(map(bool, r)) for i, *r in zip(alike, *results)}
        for i, one in enumerate(some):
            if i not in found and len(one.sales) >= LEAST_ARIMA:
                found[i] = *map(bool, fourier_arima.optimum(one.sales, _season(len(one.sales)))), bool(
                    trend_season.optimum(one.sales, one.days, one.regressors))
        checks = zip(*(found.get(i, (None, None, None)) for i in range(len(some))))
        keys = pa.concat_tables([one.keys.slice(0, 1) for one in some]).select(SERIES)
        return _result([*keys.columns, *(pa.array(c, pa.bool_()) for c in checks)], [*SERIES, "ARIMA_EXACT", "ARIMA_BEST", "TREND_OPTIMAL"])

    schema = "STORE_NBR bigint, FAMILY string, ARIMA_EXACT boolean, ARIMA_BEST boolean, TREND_OPTIMAL boolean"
    return _each_series(history, check, schema).withColumn("WEEK_START", last)


def _backtest(rows: DataFrame, weeks: DataFrame | None, model: Callable, together: Callable, least: int) -> DataFrame:
    """KEYS, PRED (floored at 0; NULL when the fit failed) and ERROR per test week.

    ``model`` (sales, days, regressors, origins) predicts each origin from the rows before it; an origin
    needs ``least`` of them. ``together`` does so for series of the same weeks; those it cannot fit are fitted alone.
    """
    weeks = test_weeks(rows) if weeks is None else weeks
    flagged = rows.join(F.broadcast(weeks.withColumn("IS_TEST", F.lit(1))), "WEEK_START", "left").withColumn("IS_TEST", F.coalesce("IS_TEST", F.lit(0)))

    def predict(some: list[Series]) -> pa.RecordBatch:
        found: dict[int, list[tuple[float | None, str | None]]] = {}
        for alike in _alike(some):
            first = some[alike[0]]
            long = [i for i in first.tests if i >= least]
            if len(alike) == 1 or not long:
                continue
            y, regressors = (np.array([getattr(some[i], c) for i in alike]) for c in ("sales", "regressors"))
            try:
                values = together(y, first.days, regressors, long)
            except (ValueError, np.linalg.LinAlgError):
                continue
            short = [(None, "too few weeks")] * (len(first.tests) - len(long))
            found |= {i: short + [*map(_checked, v)] for i, v in zip(alike, values) if np.isfinite(v).all()}
        for i, one in enumerate(some):
            if i not in found:
                found[i] = _guarded(model, one.sales, one.days, one.regressors, one.tests, least)
        keys = pa.concat_tables([one.keys.take(one.tests) for one in some])
        results = [r for i in range(len(some)) for r in found[i]]
        return _result([*keys.columns, pa.array([p for p, _ in results], pa.float64()), pa.array([e for _, e in results], pa.string())], [*KEYS, "PRED", "ERROR"])

    return _each_series(flagged, predict, RESULT)


class Series:
    """The rows of one series in the order of their weeks; ``tests`` are the places of test weeks."""

    def __init__(self, rows: pa.Table):
        self.keys = rows.select(KEYS)
        numbers = {c: rows.column(c).to_numpy().astype(float) for c in ("SALES", "DAY", *REGRESSORS)}
        self.sales, self.days = numbers["SALES"], numbers["DAY"]
        self.regressors = np.column_stack([numbers[c] for c in REGRESSORS])
        self.tests = np.flatnonzero(rows.column("IS_TEST").to_numpy()).tolist()
        self.whole = all(np.isfinite(v).all() for v in numbers.values())


def _alike(some: list[Series]) -> list[list[int]]:
    """Places of the series with the same weeks and test weeks and no missing value."""
    groups: dict[tuple, list[int]] = {}
    for i, one in enumerate(some):
        if one.whole and len(one.sales) >= LEAST_TOGETHER:
            groups.setdefault((one.days.tobytes(), tuple(one.tests)), []).append(i)
    return list(groups.values())


def _each_series(rows: DataFrame, work: Callable[[list[Series]], pa.RecordBatch], schema: str) -> DataFrame:
    """``work`` on up to TOGETHER series at a time: rows of a series follow each other, in the order of their weeks."""
    order = Window.partitionBy(*SERIES).orderBy(F.asc_nulls_last("WEEK_START"))
    amounts = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in REGRESSORS]
    placed = rows.select(*KEYS, F.unix_date("WEEK_START").alias("DAY"), F.col("SALES").cast("double").alias("SALES"), *amounts, "IS_TEST").withColumn(
        "_PLACE", F.row_number().over(order))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        some: list[Series] = []
        for batch in batches:
            starts = np.flatnonzero(batch.column("_PLACE").to_numpy() == 1).tolist()
            for at, end in zip([0, *starts], [*starts, batch.num_rows]):
                if at in starts and held:
                    some.append(Series(pa.Table.from_batches(held).combine_chunks()))
                    held = []
                    if len(some) == TOGETHER:
                        yield work(some)
                        some = []
                if end > at:
                    held.append(batch.slice(at, end - at))
        if held:
            some.append(Series(pa.Table.from_batches(held).combine_chunks()))
        if some:
            yield work(some)

    return placed.mapInArrow(whole, schema)


def _result(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.Table.from_arrays(columns, names=names).combine_chunks().to_batches()[0] if len(columns[0]) else pa.RecordBatch.from_pylist([])


def _guarded(
    model: Callable, y: np.ndarray, days: np.ndarray, regressors: np.ndarray, origins: list[int], least: int
) -> list[tuple[float | None, str | None]]:
    """(prediction, error) per origin. A history that cannot be fitted fails its own origins only."""
    long = [i for i in origins if i >= least]
    found: dict[int, tuple[float | None, str | None]] = dict.fromkeys(origins, (None, "too few weeks"))
    try:
        values = model(y, days, regressors, long) if long else []
        found |= {i: _checked(v) for i, v in zip(long, values)}
    except (ValueError, np.linalg.LinAlgError):
        for i in long:
            try:
                found[i] = _checked(model(y, days, regressors, [i])[0])
            except (ValueError, np.linalg.LinAlgError) as problem:
                found[i] = None, str(problem)
    return [found[i] for i in origins]


def _checked(value: float) -> tuple[float | None, str | None]:
    return (max(float(value), 0.0), None) if np.isfinite(value) else (None, "fit is not finite")


def _season(n: int) -> np.ndarray:
    """Yearly waves at t = 0..n-1."""
    angle = 2 * np.pi * np.outer(np.arange(n), np.arange(1, FOURIER_ORDER + 1)) / SEASON_WEEKS
    return np.hstack([np.sin(angle), np.cos(angle)])


def _arima(y: np.ndarray, _: np.ndarray, regressors: np.ndarray, origins: list[int]) -> list[float]:
    return fourier_arima.forecasts(y, _season(len(y)), origins)


def _arima_together(y: np.ndarray, _: np.ndarray, regressors: np.ndarray, origins: list[int]) -> np.ndarray:
    return fourier_arima.forecasts_together(y, _season(y.shape[1]), origins)
