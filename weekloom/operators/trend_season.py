"""Piecewise linear trend with changepoints, yearly season and regressors (numpy only).

The trend may change its slope at evenly spread places in the first part of the history.
Slope changes have a Laplace prior, so most are exactly zero; level, slope, waves and
regressors have wide normal priors. The most probable weights minimise squared errors with
an L1 penalty on slope changes and a ridge penalty on the rest. The rest has a closed form
for any slope changes, which leaves a small L1 problem: coordinate descent, then active
sets; the exact solution of the chosen changes is accepted when the optimality conditions
hold. Series with the same weeks share all columns but the regressors and are
fitted together, a step of all at a time.
"""

from __future__ import annotations

import numpy as np

from weekloom.fixed_values import (
    CHANGEPOINT_SCALE, CHANGEPOINT_SHARE, CHANGEPOINTS, TREND_SCALE, WAVE_SCALE, YEAR_DAYS, YEAR_ORDER,
)

SWEEPS, ROUNDS, TOLERANCE = 5, 200, 1e-7
#: Rounds of descent before active sets: of one series, of several at a time.
FIRST_ROUNDS, DESCENTS = 10, 1
#: Passes over noise variance and weights; the smallest noise, as a share of the largest value.
PASSES, LEAST_NOISE = 3, 1e-4


def waves(days: np.ndarray) -> np.ndarray:
    """Yearly sine and cosine columns at the given days."""
    angle = 2 * np.pi * np.outer(days, np.arange(1, YEAR_ORDER + 1)) / YEAR_DAYS
    return np.hstack([np.sin(angle), np.cos(angle)])


def changepoints(n: int) -> np.ndarray:
    """Indexes of possible slope changes within n weeks of history."""
    early = int(n * CHANGEPOINT_SHARE)
    count = min(CHANGEPOINTS, max(0, early - 1))
    return np.round(np.linspace(0, early - 1, count + 1)).astype(int)[1:] if count else np.empty(0, int)


def sparse_changes(gram: np.ndarray, target: np.ndarray, penalty: float, start: np.ndarray) -> np.ndarray:
    """The minimiser of 1/2 d'Gd - t'd + penalty |d|."""
    d = start.copy()
    slack = TOLERANCE * max(penalty, 1e-300)
    for _ in range(FIRST_ROUNDS):
        exact = _settled(gram, target, penalty, d, slack)
        if exact is not None:
            return exact
        gradient = target - gram @ d
        for _ in range(SWEEPS):
            for j in range(len(d)):
                scale = gram[j, j]
                if scale <= 0:
                    continue
                pull = gradient[j] + scale * d[j]
                new = np.sign(pull) * max(abs(pull) - penalty, 0.0) / scale
                if new != d[j]:
                    gradient -= gram[:, j] * (new - d[j])
                    d[j] = new
    return _sparse_together(gram[None], target[None], np.array([penalty]), d[None])[0]


def _settled(gram, target, penalty, d, slack) -> np.ndarray | None:
    """The exact solution with the signs of d, if it meets the optimality conditions."""
    signs = np.sign(d)
    used = np.flatnonzero(signs)
    out = np.zeros_like(d)
    if len(used):
        inner = gram[np.ix_(used, used)]
        out[used] = np.linalg.lstsq(inner, target[used] - penalty * signs[used], rcond=None)[0]
        if (np.sign(out[used]) != signs[used]).any():
            return None
    return out if violation(gram, target, penalty, out) <= slack + 1e-9 * np.abs(target).max(initial=0) else None


def violation(gram: np.ndarray, target: np.ndarray, penalty: float, d: np.ndarray) -> float:
    """By how much d misses the optimality conditions."""
    gradient = target - gram @ d
    free, used = np.maximum(np.abs(gradient) - penalty, 0)[d == 0], np.abs(gradient - penalty * np.sign(d))[d != 0]
    return float(max(free.max(initial=0), used.max(initial=0)))


class Fit:
    """Weights of one history: ``changes`` of slope at ``places``, and ``rest`` of the other columns."""

    def __init__(self, y: np.ndarray, days: np.ndarray, regressors: np.ndarray):
        n = len(y)
        self.scale = float(np.abs(y).max()) or 1.0
        self.first, self.span = days[0], max(1.0, float(days[-1] - days[0]))
        spread = regressors.std(axis=0)
        self.centre = np.where(spread > 0, regressors.mean(axis=0), 0.0)
        self.spread = np.where(spread > 0, spread, 1.0)
        self.places = self._time(days[changepoints(n)])
        target = y / self.scale
        plain, hinges = self._columns(days, regressors)
        prior = np.concatenate([[TREND_SCALE] * 2, [WAVE_SCALE] * (plain.shape[1] - 2)])
        inner, cross, own = plain.T @ plain, plain.T @ hinges, plain.T @ target
        square, pull = hinges.T @ hinges, hinges.T @ target
        self.changes = np.zeros(hinges.shape[1])
        variance = None
        for _ in range(PASSES):
            ridge = np.diag((variance if variance is not None else LEAST_NOISE) / prior**2)
            solved = np.linalg.solve(inner + ridge, np.column_stack([cross, own]))
            if variance is not None and len(self.changes):
                self.gram, self.pull = square - cross.T @ solved[:, :-1], pull - cross.T @ solved[:, -1]
                self.penalty = variance / CHANGEPOINT_SCALE
                self.changes = sparse_changes(self.gram, self.pull, self.penalty, self.changes)
            self.rest = solved[:, -1] - solved[:, :-1] @ self.changes
            errors = target - plain @ self.rest - hinges @ self.changes
            variance = max(float((errors**2).mean()), LEAST_NOISE**2)

    def _time(self, days: np.ndarray) -> np.ndarray:
        return (days - self.first) / self.span

    def _columns(self, days: np.ndarray, regressors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        t = self._time(days)
        plain = np.column_stack([np.ones(len(t)), t, waves(days), (regressors - self.centre) / self.spread])
        return plain, np.maximum(t[:, None] - self.places[None, :], 0.0)

    def at(self, days: np.ndarray, regressors: np.ndarray) -> np.ndarray:
        plain, hinges = self._columns(days, regressors)
        return self.scale * (plain @ self.rest + hinges @ self.changes)


def optimum(y: np.ndarray, days: np.ndarray, regressors: np.ndarray) -> bool:
    """Whether the slope changes fitted to a whole history meet the optimality conditions."""
    fit = Fit(y, days, regressors)
    if not len(fit.changes):
        return True
    return violation(fit.gram, fit.pull, fit.penalty, fit.changes) <= 1e-4 * fit.penalty + 1e-8


def forecasts(y: np.ndarray, days: np.ndarray, regressors: np.ndarray, origins: list[int]) -> list[float]:
    """For each origin i, the value at i from y[:i], and the days and regressors up to i."""
    return [float(Fit(y[:i], days[:i], regressors[:i]).at(days[i : i + 1], regressors[i : i + 1])[0]) for i in origins]


def forecasts_together(y: np.ndarray, days: np.ndarray, regressors: np.ndarray, origins: list[int]) -> np.ndarray:
    """``forecasts`` of each row of y (s x n), with regressors (s x n x k) and shared days: s x origins."""
    return np.column_stack([_forecast_together(y[:, :i], days, regressors[:, : i + 1], i) for i in origins])


def optima(y: np.ndarray, days: np.ndarray, regressors: np.ndarray) -> np.ndarray:
    """``optimum`` of each whole row of y (s x n), with regressors (s x n x k) and shared days."""
    n = y.shape[1]
    changes, problem = _fit_together(y, days, regressors, n)[:2]
    if problem is None:
        return np.ones(len(y), bool)
    gram, pull, penalty = problem
    gradient = pull - (gram @ changes[:, :, None])[:, :, 0]
    missed = np.where(changes == 0, np.abs(gradient) - penalty[:, None], np.abs(gradient - penalty[:, None] * np.sign(changes)))
    return np.maximum(missed, 0).max(axis=1) <= 1e-4 * penalty + 1e-8


def _forecast_together(y: np.ndarray, days: np.ndarray, regressors: np.ndarray, n: int) -> np.ndarray:
    """The value at week n of what the first n weeks give."""
    changes, _, rest, scale, own, shared, hinges = _fit_together(y, days, regressors, n)
    k = shared.shape[1]
    return scale[:, 0] * (rest[:, :k] @ shared[n] + (own[:, n] * rest[:, k:]).sum(axis=1) + changes @ hinges[n])


def _fit_together(y: np.ndarray, days: np.ndarray, regressors: np.ndarray, n: int) -> tuple:
    """As ``Fit`` of the first n weeks, step by step: changes, their problem (gram, pull and penalty; None if no change is
    possible), rest and scale, and the columns of all given weeks."""
    scale = np.abs(y).max(axis=1)
    scale = np.where(scale > 0, scale, 1.0)[:, None]
    target = y / scale
    past = regressors[:, :n]
    spread = past.std(axis=1)
    centre, spread = np.where(spread > 0, past.mean(axis=1), 0.0), np.where(spread > 0, spread, 1.0)
    own = (regressors - centre[:, None]) / spread[:, None]
    time = (days[: n + 1] - days[0]) / max(1.0, float(days[n - 1] - days[0]))
    shared = np.column_stack([np.ones(len(time)), time, waves(days[: n + 1])])
    hinges = np.maximum(time[:, None] - time[changepoints(n)][None, :], 0.0)
    turned, k, m, problem = own[:, :n].transpose(0, 2, 1), shared.shape[1], hinges.shape[1], None
    early, bends = shared[:n], hinges[:n]
    width = k + own.shape[2]
    inner, cross, pulls = (np.empty((len(y), width, c)) for c in (width, m, 1))
    inner[:, :k, :k], cross[:, :k], pulls[:, :k, 0] = early.T @ early, early.T @ bends, target @ early
    inner[:, k:, :k], inner[:, k:, k:] = turned @ early, turned @ own[:, :n]
    inner[:, :k, k:] = inner[:, k:, :k].transpose(0, 2, 1)
    cross[:, k:], pulls[:, k:] = turned @ bends, turned @ target[:, :, None]
    square, pull = bends.T @ bends, target @ bends
    prior = np.concatenate([[TREND_SCALE] * 2, [WAVE_SCALE] * (width - 2)])
    both, diagonal = np.concatenate([cross, pulls], axis=2), np.arange(width)
    changes, noise = np.zeros((len(y), m)), np.full(len(y), LEAST_NOISE)
    for step in range(PASSES):
        ridged = inner.copy()
        ridged[:, diagonal, diagonal] += noise[:, None] / prior**2
        solved = np.linalg.solve(ridged, both)
        if step and m:
            left = both.transpose(0, 2, 1)[:, :m] @ solved
            problem = square - left[:, :, :m], pull - left[:, :, m], noise / CHANGEPOINT_SCALE
            changes = _sparse_together(*problem, changes)
        rest = solved[:, :, m] - (solved[:, :, :m] @ changes[:, :, None])[:, :, 0]
        errors = target - rest[:, :k] @ early.T - (own[:, :n] @ rest[:, k:, None])[:, :, 0] - changes @ bends.T
        noise = np.maximum((errors**2).mean(axis=1), LEAST_NOISE**2)
    return changes, problem, rest, scale, own, shared, hinges


def _sparse_together(gram: np.ndarray, target: np.ndarray, penalty: np.ndarray, start: np.ndarray) -> np.ndarray:
    """``sparse_changes`` of each row; rows leave as they settle.

    What descent leaves unsettled goes on by active sets: straight towards the exact solution of the chosen changes
    until one of them vanishes, or there, with the change added that misses its condition most.
    """
    out, rows, d, signs = np.empty_like(start), np.arange(len(start)), start.copy(), np.sign(start)
    slack = TOLERANCE * np.maximum(penalty, 1e-300) + 1e-9 * np.abs(target).max(axis=1)
    for step in range(ROUNDS):
        exact, gradient = _exact_together(gram, target, penalty, signs)
        used = signs != 0
        kept = (np.sign(exact) == signs).all(axis=1)
        missed = np.where(used, np.abs(gradient - penalty[:, None] * signs), np.abs(gradient) - penalty[:, None])
        done = kept & (missed.max(axis=1) <= slack)
        out[rows[done]] = exact[done]
        if done.all():
            return out
        if done.any():
            rows, gram, target, penalty, d, signs, slack, exact, gradient, used, kept, missed = (
                a[~done] for a in (rows, gram, target, penalty, d, signs, slack, exact, gradient, used, kept, missed))
        if step < DESCENTS:
            _descend_together(gram, target, penalty, d)
            signs = np.sign(d)
            continue
        every = np.arange(len(rows))
        reach = np.where(used & (exact * signs <= 0), d / np.where(d == exact, 1.0, d - exact), np.inf)
        first = reach.argmin(axis=1)
        part = np.where(kept, 1.0, np.clip(reach[every, first], 0.0, 1.0))[:, None]
        d = np.where(kept[:, None], exact, d + part * (exact - d))
        worst = np.where(used, -np.inf, missed).argmax(axis=1)
        at = np.where(kept, worst, first)
        d[every, at] = 0.0
        signs[every, at] = np.where(kept, np.sign(gradient[every, worst]), 0.0)
    out[rows] = d
    return out


def _descend_together(gram: np.ndarray, target: np.ndarray, penalty: np.ndarray, d: np.ndarray) -> None:
    """Sweeps of coordinate descent, in place."""
    gradient = target - (gram @ d[:, :, None])[:, :, 0]
    for _ in range(SWEEPS):
        for j in range(d.shape[1]):
            scale = gram[:, j, j]
            moves = scale > 0
            pull = gradient[:, j] + scale * d[:, j]
            new = np.sign(pull) * np.maximum(np.abs(pull) - penalty, 0.0) / np.where(moves, scale, 1.0)
            by = np.where(moves, new - d[:, j], 0.0)
            gradient -= gram[:, j] * by[:, None]
            d[:, j] = np.where(moves, new, d[:, j])


def _exact_together(gram, target, penalty, signs) -> tuple[np.ndarray, np.ndarray]:
    """The exact solutions with the given signs, and the gradients there."""
    used = signs != 0
    inner = np.where(used[:, :, None] & used[:, None, :], gram, 0.0)
    places = np.arange(signs.shape[1])
    inner[:, places, places] += ~used
    pulls = np.where(used, target - penalty[:, None] * signs, 0.0)[:, :, None]
    try:
        out = np.linalg.solve(inner, pulls)[:, :, 0]
    except np.linalg.LinAlgError:
        out = (np.linalg.pinv(inner, hermitian=True) @ pulls)[:, :, 0]
    return out, target - (gram @ out[:, :, None])[:, :, 0]
