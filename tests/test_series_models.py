"""Both per-series models against independent forms of the same problem (numpy only)."""

import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekloom.operators import fourier_arima, series_models, trend_season


def dense_likelihood(steps, waves, phi, theta):
    """Log likelihood from the full covariance matrix of an ARMA(1,1) process."""
    n = len(steps)
    covariance = np.empty(n)
    covariance[0] = (1 + 2 * phi * theta + theta**2) / (1 - phi**2)
    covariance[1:] = (phi + theta) * (1 + phi * theta) / (1 - phi**2) * phi ** np.arange(n - 1)
    full = covariance[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
    inverse = np.linalg.inv(full)
    weights = np.linalg.solve(waves.T @ inverse @ waves, waves.T @ inverse @ steps)
    rest = steps - waves @ weights
    variance = rest @ inverse @ rest / n
    return -0.5 * (n * np.log(2 * np.pi * variance) + np.linalg.slogdet(full)[1] + n)


def likelihood(steps, waves, phi, theta):
    return fourier_arima.profiles(np.column_stack([waves, steps]), np.array([phi]), np.array([theta]))[0]


def arma(seed, n, phi, theta):
    draw = np.random.default_rng(seed)
    shocks, out = draw.normal(size=n + 50), np.zeros(n + 50)
    for t in range(1, n + 50):
        out[t] = phi * out[t - 1] + shocks[t] + theta * shocks[t - 1]
    return out[50:]


def yearly(n):
    angle = 2 * np.pi * np.outer(np.arange(n), [1, 2]) / 52
    return np.hstack([np.sin(angle), np.cos(angle)])


@pytest.mark.parametrize("phi, theta", [(0.6, 0.3), (-0.7, 0.5), (0.95, -0.9), (0.0, 0.0)])
def test_filter_likelihood_is_that_of_the_covariance_matrix(phi, theta):
    steps, waves = arma(1, 60, 0.5, 0.2) + yearly(60) @ [1, 2, 3, 4], yearly(60)
    assert likelihood(steps, waves, phi, theta) == pytest.approx(dense_likelihood(steps, waves, phi, theta), abs=1e-7)


def test_search_beats_the_two_stage_estimate_and_a_fine_grid():
    fine = np.linspace(-0.98, 0.98, 50)
    grid = np.array(list(itertools.product(fine, fine)))
    for seed, (phi, theta) in enumerate([(0.5, 0.3), (-0.6, -0.3), (0.9, -0.7), (0.2, 0.9), (0.0, 0.0)]):
        columns = np.column_stack([yearly(140), arma(seed, 140, phi, theta)])
        for end, (value, p, t) in zip((100, 140), fourier_arima.fitted(columns, [100, 140])):
            steps, waves = columns[:end, -1], columns[:end, :-1]
            assert value == pytest.approx(likelihood(steps, waves, p, t))
            assert value >= likelihood(steps, waves, *fourier_arima.two_stage(steps, waves)) - 1e-9
            assert value >= fourier_arima.profiles(columns[:end], *grid.T).max() - 1e-3


def test_coefficients_are_found_and_forecast_uses_them():
    columns = np.column_stack([yearly(1500), arma(9, 1500, 0.7, -0.3)])
    _, phi, theta = fourier_arima.fitted(columns, [1500])[0]
    assert phi == pytest.approx(0.7, abs=0.12) and theta == pytest.approx(-0.3, abs=0.15)
    y = np.cumsum(columns[:, -1])
    together = fourier_arima.forecasts(y, yearly(1500), [300, 400])
    assert together == pytest.approx([fourier_arima.forecasts(y[:i], yearly(i + 1), [i])[0] for i in (300, 400)], rel=1e-9)


def test_flat_series_are_forecast_flat():
    assert fourier_arima.forecasts(np.full(80, 5.0), yearly(81), [80])[0] == pytest.approx(5.0)
    assert trend_season.forecasts(np.zeros(80), np.arange(81.0) * 7, np.zeros((81, 2)), [80]) == [pytest.approx(0.0)]


def kinked(seed, n=320, noise=1.0):
    """A line that turns at two of the possible places, with season, a regressor and noise."""
    draw = np.random.default_rng(seed)
    days, t = np.arange(n) * 7.0 + 14_000, np.arange(n)
    places = trend_season.changepoints(n)[[7, 16]]
    y = 100 + 0.5 * t + 2.0 * np.maximum(t - places[0], 0) - 3.5 * np.maximum(t - places[1], 0)
    regressors = draw.integers(0, 3, size=(n, 2)).astype(float)
    return y + 10 * np.sin(2 * np.pi * days / 365.25) + 4 * regressors[:, 0] + noise * draw.normal(size=n), days, regressors, places


def test_planted_changepoints_are_found():
    for seed in range(3):
        y, days, regressors, places = kinked(seed)
        fit = trend_season.Fit(y, days, regressors)
        where = trend_season.changepoints(len(y))
        size = np.abs(fit.changes)
        near = np.array([np.abs(where - p).min() for p in places])
        strong = where[np.argsort(-size)[:2]]
        assert (near == 0).all() and all(np.abs(strong - p).min() <= 12 for p in places)
        assert (size == 0).sum() >= len(size) // 2
        assert np.sign(fit.changes[where == places[0]])[0] >= 0 >= np.sign(fit.changes[where == places[1]])[0]
        # Beyond the history, the line goes on with its last slope.
        ahead = days[-1] + 7 * np.arange(1, 3)
        assert np.diff(fit.at(ahead, np.zeros((2, 2))) - fit.at(ahead - 7, np.zeros((2, 2))))[0] == pytest.approx(0, abs=1.0)


def test_optimality_conditions_hold():
    for seed in range(6):
        y, days, regressors, _ = kinked(seed, 60 + 50 * seed, 1.0 + 5 * seed)
        fit = trend_season.Fit(y, days, regressors)
        assert trend_season.violation(fit.gram, fit.pull, fit.penalty, fit.changes) <= 1e-6 * fit.penalty + 1e-8
    draw = np.random.default_rng(5)
    x, target = draw.normal(size=(40, 6)), draw.normal(size=40)
    gram, pull = x.T @ x, x.T @ target
    found = trend_season.sparse_changes(gram, pull, 3.0, np.zeros(6))
    value = lambda d: 0.5 * d @ gram @ d - pull @ d + 3.0 * np.abs(d).sum()
    assert all(value(found) <= value(found + 1e-4 * draw.normal(size=6)) for _ in range(200))


def test_each_origin_sees_its_own_past_only():
    y, days, regressors, _ = kinked(4, 150)
    spiked = y.copy()
    spiked[140:] = 1e9
    assert trend_season.forecasts(y, days, regressors, [130, 140]) == trend_season.forecasts(spiked, days, regressors, [130, 140])
    waves = yearly(150)
    assert fourier_arima.forecasts(y, waves, [130, 140]) == fourier_arima.forecasts(spiked, waves, [130, 140])


def many(seed, s=9, n=150):
    draw = np.random.default_rng(seed)
    y = np.where(draw.random((s, n)) < draw.uniform(0.1, 1, (s, 1)), np.round(draw.random((s, n)) * 5000, 2), 0.0)
    y[1], y[2] = 5.0, np.cumsum(draw.normal(size=n))
    return y, np.arange(n) * 7.0 + 9000, draw.integers(0, 3, size=(s, n, 2)).astype(float)


def test_likelihood_of_many_series_is_the_filters():
    y, *_ = many(1)
    waves, steps, ends = np.diff(yearly(150), axis=0), np.diff(y), [120, 149]
    draw = np.random.default_rng(2)
    place, phi = draw.uniform(-3, 3, (2, 9, 4)), np.tanh(draw.uniform(-3, 3, (2, 9, 4, 3)))
    found = fourier_arima.Together(waves, steps, ends).values(place, phi)
    for (e, n), s in itertools.product(enumerate(ends), [0, *range(2, 9)]):
        alone = fourier_arima.profiles(np.column_stack([waves[:n], steps[s, :n]]), phi[e, s].ravel(), np.tanh(np.repeat(place[e, s], 3)))
        assert found[e, s].ravel() == pytest.approx(alone, abs=1e-7)


def test_series_fitted_together_are_forecast_as_alone():
    y, days, regressors = many(3)
    origins = [120, 140, 149]
    arima, trend = fourier_arima.forecasts_together(y, yearly(150), origins), trend_season.forecasts_together(y, days, regressors, origins)
    for s in range(len(y)):
        room = 1e-6 * max(1, np.abs(y[s]).max())
        assert arima[s] == pytest.approx(fourier_arima.forecasts(y[s], yearly(150), origins), abs=room)
        assert trend[s] == pytest.approx(trend_season.forecasts(y[s], days, regressors[s], origins), abs=room)


def test_a_sharp_turn_reaches_the_optimum():
    draw = np.random.default_rng(0)
    for seed in range(12):  # plain descent missed some by more than a hundredth of the penalty
        n = 330 + 2 * seed
        fit = trend_season.Fit(np.abs(np.arange(n) - 150) + draw.normal(size=n), np.arange(n) * 7.0, draw.integers(0, 3, (n, 2)).astype(float))
        assert trend_season.violation(fit.gram, fit.pull, fit.penalty, fit.changes) <= 1e-6 * fit.penalty + 1e-8


def test_series_are_told_apart_in_any_batches(spark):
    y, _, _ = many(5, 7, 130)
    first = dt.date(2018, 1, 1)
    made = [(None if s == 3 else s, "A", first + dt.timedelta(weeks=t), float(y[s, t]) if (s, t) != (4, 60) else None, 1, None, 0)
            for s in range(7) for t in range(130 if s != 5 else 9)]
    rows = spark.createDataFrame(made, "STORE_NBR bigint, FAMILY string, WEEK_START date, SALES double, PROMO_ITEMS bigint, HOLIDAY_DAYS bigint, IS_FUTURE int")
    weeks = rows.select("WEEK_START").distinct().orderBy("WEEK_START").offset(7)
    weeks = weeks.where(F.col("WEEK_START").isin(first + dt.timedelta(weeks=8), first + dt.timedelta(weeks=128), first + dt.timedelta(weeks=129)))
    found = series_models.backtest_arima(rows, weeks).collect()
    assert len(found) == 6 * 3 + 1 and sum(r.STORE_NBR is None for r in found) == 3
    assert {r.ERROR for r in found if r.WEEK_START == first + dt.timedelta(weeks=8)} == {"too few weeks"}
    for r in found:
        if r.ERROR is None:
            s, t = 3 if r.STORE_NBR is None else r.STORE_NBR, (r.WEEK_START - first).days // 7
            alone = fourier_arima.forecasts(y[s], series_models._season(130), [t])[0]
            assert r.PRED == pytest.approx(max(alone, 0.0), abs=1e-6 * max(1, y[s].max()))
    assert {r.STORE_NBR for r in found if r.ERROR and r.WEEK_START > first + dt.timedelta(weeks=9)} == {4}
    checked = series_models.check_fits(rows.where("STORE_NBR <> 4"), weeks).collect()
    assert len(checked) == 5 and all(r.ARIMA_EXACT is None for r in checked)


def test_missing_sales_fail_their_own_origins_at_once():
    y, days, regressors = many(7)
    y[0, 60] = np.nan
    found = series_models._guarded(trend_season.forecasts, y[0], days, regressors[0], [50, 140], 2)
    assert found[0][1] is None and found[1] == (None, "SVD did not converge in Linear Least Squares")


def test_covariance_likelihoods_of_many_are_the_dense_ones():
    y, *_ = many(11)
    waves, steps = np.diff(yearly(150), axis=0), np.delete(np.diff(y), 1, axis=0)
    draw = np.random.default_rng(12)
    phi, theta = np.tanh(draw.uniform(-3, 3, (2, len(steps))))
    columns = np.concatenate([np.repeat(waves[:, None], len(steps), axis=1), steps.T[:, :, None]], axis=2)
    found = fourier_arima.covariance_likelihoods(columns, phi, theta)
    for s, row in enumerate(steps):
        assert found[s] == pytest.approx(dense_likelihood(row, waves, phi[s], theta[s]), abs=1e-5)


def test_fits_checked_together_hold_to_what_they_do_alone(monkeypatch):
    y, days, regressors = many(13)
    exact, best = fourier_arima.optima(y, yearly(150))
    assert list(zip(exact, best)) == [fourier_arima.optimum(row, yearly(150)) for row in y]
    assert trend_season.optima(y, days, regressors).tolist() == [trend_season.optimum(y[s], days, regressors[s]) for s in range(len(y))]
    # A wrong likelihood, a search that stays at its first guess and changes that are no optimum are told.
    monkeypatch.setattr(fourier_arima, "covariance_likelihoods", lambda c, p, t: np.zeros(c.shape[1]))
    monkeypatch.setattr(fourier_arima.Together, "fitted", lambda self: (np.full((1, len(y)), 0.9), np.full((1, len(y)), 0.9)))
    exact, best = fourier_arima.optima(np.cumsum(y, axis=1), yearly(150))
    assert not exact.any() and not best[[0, *range(3, 9)]].any()
    monkeypatch.setattr(trend_season, "_sparse_together", lambda gram, target, penalty, start: start + 1.0)
    assert not trend_season.optima(y, days, regressors)[3:].any()


def test_one_filter_pass_serves_all_origins():
    y, *_ = many(14, 5)
    waves, steps, ends = np.diff(yearly(150), axis=0), np.diff(y), [100, 149]
    place = np.random.default_rng(15).uniform(-3, 3, (2, 5, 3))
    shared, own = fourier_arima.Together(waves, steps, ends)._sums_at(place)
    for (e, n), s, r in itertools.product(enumerate(ends), range(5), range(3)):
        columns = np.column_stack([waves[:n], np.eye(n, 1), steps[s, :n]])
        f = columns.copy()
        for t in range(1, n):
            f[t] = columns[t] - np.tanh(place[e, s, r]) * f[t - 1]
        x, w, early, late = f[:, -1], f[:, :-2], slice(0, -1), slice(1, None)
        sums = [x @ x, 2 * x[late] @ x[early], *(w.T @ x), *(w[late].T @ x[early] + w[early].T @ x[late]), x[-1], f[:, -2] @ x]
        assert own[:, e, s, r] == pytest.approx(sums, rel=1e-7, abs=1e-7 * (1 + x @ x))
        assert shared[: 10, e, s, r] == pytest.approx((w.T @ w)[np.triu_indices(4)], rel=1e-7, abs=1e-7)
