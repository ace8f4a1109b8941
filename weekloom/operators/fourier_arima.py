"""ARIMA(1,1,1) errors around yearly waves, by exact Gaussian likelihood (numpy only).

The first differences of a series are a regression on the differences of the waves with
ARMA(1,1) errors. For given coefficients the Kalman filter of that process is a scalar
recursion; it turns series and waves into independent innovations, on which the regression
weights and the variance have a closed form. What is left is a likelihood of two numbers,
searched per series: the tops of a grid and the two-stage regression estimate, each followed
uphill in ever finer steps. As the filter never looks ahead, one pass serves all origins of
a backtest; each origin's search depends on its own past alone.

Series of one length share their waves and are searched together. Written out for an unknown
first shock, the likelihood needs a filter of the moving average alone: the other coefficient
enters in closed form, and the sums over waves and series are smooth functions of one number, known
from their values at fixed places, so each series is filtered there only, once for all origins.
"""

from __future__ import annotations

import numpy as np

LONG_AR = 4
#: The search runs over artanh of both coefficients.
GRID, WIDEST, LIMIT = 17, 2.6, 3.0
TOPS, REFINEMENTS, SHRINK = 2, 18, 0.4
#: Places at which sums over filtered columns are known, and searches (of a series at an end) made together.
PLACES, TOGETHER = 104, 256
AROUND = [0, -1, 1]


def innovations(columns: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One-step errors (c, n, k) of n x k (or n x c x k) columns under c ARMA(1,1) processes, and their relative variances (c, n)."""
    n, k = len(columns), columns.shape[-1]
    errors, variances = np.empty((len(phi), n, k)), np.empty((len(phi), n))
    variance = (1 + 2 * phi * theta + theta**2) / (1 - phi**2)
    error = np.broadcast_to(columns[0], (len(phi), k))
    errors[:, 0], variances[:, 0] = error, variance
    for t in range(1, n):
        error = columns[t] - phi[:, None] * columns[t - 1] - (theta / variance)[:, None] * error
        variance = 1 + theta**2 - theta**2 / variance
        errors[:, t], variances[:, t] = error, variance
    return errors, variances


def moments(errors: np.ndarray, variances: np.ndarray, ends: list[int]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each n of ends (ascending): n, products of the first n standardised errors (c, k, k), sum of log variances (c)."""
    scaled = errors / np.sqrt(variances)[:, :, None]
    logs = np.log(variances)
    out, before = [], 0
    products, sums = np.zeros((errors.shape[0], errors.shape[2], errors.shape[2])), np.zeros(len(errors))
    for n in ends:
        part = scaled[:, before:n]
        products, sums, before = products + part.transpose(0, 2, 1) @ part, sums + logs[:, before:n].sum(axis=1), n
        out.append((n, products, sums))
    return out


def profile(n: int, products: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood (c) at the best weights and variance, and those weights (c, k - 1); the last column is the series."""
    inner, cross, square = products[:, :-1, :-1], products[:, :-1, -1], products[:, -1, -1]
    spread = np.trace(inner, axis1=1, axis2=2)
    weights = np.linalg.solve(inner + (1e-13 * spread + 1e-300)[:, None, None] * np.eye(inner.shape[1]), cross[:, :, None])[:, :, 0]
    mean_square = np.maximum(square - (cross * weights).sum(axis=1), 1e-13 * square + 1e-200) / n
    return -0.5 * (n * (np.log(2 * np.pi * mean_square) + 1) + logs), weights


def profiles(columns: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """Exact log likelihoods of the last column under c processes, the others its regressors."""
    return profile(*moments(*innovations(columns, phi, theta), [len(columns)])[0])[0]


def two_stage(steps: np.ndarray, waves: np.ndarray) -> tuple[float, float]:
    """Coefficients by two regressions (Hannan and Rissanen): a long autoregression gives the shocks."""
    n = len(steps)
    rest = steps - waves @ _least_squares(waves, steps)
    lags = np.column_stack([rest[LONG_AR - k : n - k] for k in range(1, LONG_AR + 1)])
    shocks = np.concatenate([np.zeros(LONG_AR), rest[LONG_AR:] - lags @ _least_squares(lags, rest[LONG_AR:])])
    design = np.column_stack([rest[LONG_AR - 1 : n - 1], shocks[LONG_AR - 1 : n - 1]])
    phi, theta = np.clip(_least_squares(design, rest[LONG_AR:]), -0.99, 0.99)
    return float(phi), float(theta)


def fitted(columns: np.ndarray, ends: list[int]) -> list[tuple[float, float, float]]:
    """(log likelihood, phi, theta) of the best process for the first n rows of columns, for each n of ends (ascending)."""
    columns = columns[: ends[-1]]
    axis = np.linspace(-WIDEST, WIDEST, GRID)
    grid = np.stack(np.meshgrid(axis, axis, indexing="ij"), axis=-1)
    at = []
    for found in moments(*innovations(columns, *np.tanh(grid.reshape(-1, 2).T)), ends):
        surface = profile(*found)[0].reshape(GRID, GRID)
        top = surface >= _neighbours(surface)
        guess = np.arctanh(two_stage(columns[: found[0], -1], columns[: found[0], :-1]))
        starts = grid[top][np.argsort(-surface[top], kind="stable")][:TOPS]
        at.append(np.vstack([starts, np.repeat(guess[None], TOPS + 1 - len(starts), axis=0)]))
    at = np.array(at)  # origin, start, coefficient
    around = np.stack(np.meshgrid(AROUND, AROUND), axis=-1).reshape(-1, 2)
    size = np.full(at.shape[:2], 0.5 * (axis[1] - axis[0]))
    for _ in range(REFINEMENTS):
        points = np.clip(at[:, :, None, :] + size[:, :, None, None] * around, -LIMIT, LIMIT)
        errors, variances = innovations(columns, *np.tanh(points.reshape(-1, 2).T))
        shape = (len(ends), -1, *errors.shape[1:])
        values = np.array([
            profile(*moments(e[:, :n], v[:, :n], [n])[0])[0]
            for n, e, v in zip(ends, errors.reshape(shape), variances.reshape(shape[:-1]))]).reshape(points.shape[:3])
        best = values.argmax(axis=2)
        at = np.take_along_axis(points, best[:, :, None, None], axis=2)[:, :, 0]
        size = np.where(best == 0, size * SHRINK, size)  # the middle is tried first
    tops = np.take_along_axis(values, best[:, :, None], axis=2)[:, :, 0]
    winner = tops.argmax(axis=1)
    return [(float(tops[o, w]), *map(float, np.tanh(at[o, w]))) for o, w in enumerate(winner)]


def _neighbours(surface: np.ndarray) -> np.ndarray:
    """The largest of the eight values around each."""
    wide = np.pad(surface, 1, constant_values=-np.inf)
    n, m = surface.shape
    return np.max([wide[1 + a : 1 + a + n, 1 + b : 1 + b + m] for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b], axis=0)


class Together:
    """The likelihood of s series of one length (s x n steps) with shared waves (n x k), for all ends at once."""

    def __init__(self, waves: np.ndarray, steps: np.ndarray, ends: list[int]):
        self.ends, self.length = np.array(ends), ends[-1]
        self.waves, self.steps = waves[: self.length], np.ascontiguousarray(steps[:, : self.length].T)
        self.k = waves.shape[1]
        self.upper = np.triu_indices(self.k)
        self.shared, self.own = self._sums()

    def _sums(self) -> tuple[np.ndarray, np.ndarray]:
        """Chebyshev coefficients over artanh of theta of what the likelihood takes from the filtered columns. Of the waves
        (end, value, place): sums of products at lags 0 and 1, last values and products with the filtered first shock. Of
        each series (end, series, value, place): the same with the waves and with itself. A filter pass at a place serves all ends."""
        angles = np.pi * (np.arange(PLACES) + 0.5) / PLACES
        theta = np.tanh(LIMIT * np.cos(angles))
        columns = np.hstack([self.waves, np.eye(self.length, 1)])
        filtered, series = np.empty((PLACES, *columns.shape)), np.empty((PLACES, *self.steps.shape))
        filtered[:, 0], series[:, 0] = columns[0], self.steps[0]
        for t in range(1, self.length):
            filtered[:, t] = columns[t] - theta[:, None] * filtered[:, t - 1]
            series[:, t] = self.steps[t] - theta[:, None] * series[:, t - 1]
        k, count = self.k, self.steps.shape[1]
        same, lagged = np.zeros((2, PLACES, k + 1, k + 1))
        crossed, cross_lagged = np.zeros((2, PLACES, k + 1, count))
        square, square_lagged = np.zeros((2, PLACES, count))
        shared, own, before = [], [], 0
        for n in self.ends:
            new, late, early = slice(before, n), slice(max(before, 1), n), slice(max(before, 1) - 1, n - 1)
            f, x = filtered.transpose(0, 2, 1), filtered
            same = same + f[:, :, new] @ x[:, new]
            step = f[:, :, late] @ x[:, early]
            lagged = lagged + step + step.transpose(0, 2, 1)
            crossed = crossed + f[:, :, new] @ series[:, new]
            cross_lagged = cross_lagged + f[:, :, late] @ series[:, early] + f[:, :, early] @ series[:, late]
            square = square + np.einsum("pts,pts->ps", series[:, new], series[:, new])
            square_lagged = square_lagged + 2 * np.einsum("pts,pts->ps", series[:, late], series[:, early])
            at = (slice(None), *self.upper)
            shared.append(np.hstack([same[at], lagged[at], filtered[:, n - 1, :-1], same[:, -1, :-1]]))
            own.append(np.concatenate([
                square[:, None], square_lagged[:, None], crossed[:, :-1], cross_lagged[:, :-1], series[:, n - 1, None], crossed[:, -1:]], axis=1))
            before = n
        turn = np.cos(np.outer(np.arange(PLACES), angles)) * (2 / PLACES)
        turn[0] /= 2
        shared, own = np.array(shared), np.array(own)  # end, place, value; end, place, value, series
        by_series = (turn @ own.reshape(len(self.ends), PLACES, -1)).reshape(own.shape)
        return np.ascontiguousarray((turn @ shared).transpose(0, 2, 1)), np.ascontiguousarray(by_series.transpose(0, 3, 2, 1))

    def _grid(self, axis: np.ndarray) -> np.ndarray:
        """Log likelihoods (end, series, theta, phi) at all pairs of the axis, which all series share."""
        terms = _chebyshev(axis / LIMIT)
        shared, own = np.moveaxis(self.shared @ terms, 1, 0)[:, :, None], np.moveaxis(self.own @ terms, 2, 0)
        return self._likelihood(self.ends[:, None, None], np.tanh(axis), np.tanh(axis), shared, own)

    def values(self, place: np.ndarray, phi: np.ndarray) -> np.ndarray:
        """Log likelihoods at artanh of theta (end, series, r) and phi (end, series, r, c), shaped as phi."""
        return self._likelihood(self.ends[:, None, None], np.tanh(place), phi, *self._sums_at(place))

    def _sums_at(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of ``_sums`` (value, end, series, r) at artanh of theta (end, series, r), of the waves and of the series."""
        terms = _chebyshev(place.ravel() / LIMIT).reshape(PLACES, len(place), -1).transpose(1, 0, 2)
        each = terms.reshape(*terms.shape[:2], *place.shape[1:]).transpose(0, 2, 1, 3)
        return np.moveaxis(self.shared @ terms, 1, 0).reshape(-1, *place.shape), np.moveaxis(self.own @ each, 2, 0)

    def _likelihood(self, n: np.ndarray, theta: np.ndarray, phi: np.ndarray, shared: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Log likelihoods of the first n steps, given the values of ``_sums`` at theta (..., r) for phi (..., r, c)."""
        k, pairs = self.k, len(self.upper[0])
        same, lagged, wave_last, wave_first = np.split(shared, [pairs, 2 * pairs, 2 * pairs + k])
        square, square_lagged, crossed, cross_lagged, last, first = np.split(own, [1, 2, 2 + k, 2 + 2 * k, 3 + 2 * k])
        # Lags 0 and 1, last values and products with the first shock, of waves and series.
        lasts, firsts = [*wave_last, *last], [*wave_first, *first]
        decay = (-theta) ** (n - 1)
        known = [f[..., None] + phi * (theta * (f - decay * x))[..., None] for f, x in zip(firsts, lasts)]
        theta, n = theta[..., None], n[..., None]
        scale = 1 + 2 * phi * theta + theta**2
        weight = (phi + theta) ** 2 / scale
        spread = 1 + weight * (theta**2 * (1 - theta ** (2 * (n - 1))) / (1 - theta**2))
        weight = weight / spread
        lowered, squared = [weight * x for x in known], phi**2
        matrix: dict[tuple[int, int], np.ndarray] = {}
        pair = {(i, j): at for at, (i, j) in enumerate(zip(*self.upper))}
        for i in range(k + 1):
            for j in range(i, k + 1):
                zero, one = (square[0], square_lagged[0]) if i == k else (crossed[i], cross_lagged[i]) if j == k else (same[pair[i, j]], lagged[pair[i, j]])
                cell = squared * (zero - lasts[i] * lasts[j])[..., None]
                cell -= phi * one[..., None]
                cell += zero[..., None]
                cell -= lowered[i] * known[j]
                matrix[i, j] = cell
        room = 1e-13 * sum(matrix[i, i] for i in range(k)) + 1e-300
        whole = matrix[k, k].copy()
        for i in range(k):
            matrix[i, i] = matrix[i, i] + room
        for p in range(k):
            for i in range(p + 1, k + 1):
                share = matrix[p, i] / matrix[p, p]
                for j in range(i, k + 1):
                    matrix[i, j] -= share * matrix[p, j]
        mean_square = np.maximum(matrix[k, k], 1e-13 * whole + 1e-200) / n
        return -0.5 * (n * (np.log(2 * np.pi * mean_square) + 1) + np.log(scale / (1 - phi**2)) + np.log(spread))

    def two_stage(self) -> np.ndarray:
        """As the function of this name: coefficients (end, series, 2)."""
        out = []
        for n in self.ends:
            waves, steps = self.waves[:n], self.steps[:n].T
            rest = steps - steps @ np.linalg.pinv(waves).T @ waves.T
            lags = np.stack([rest[:, LONG_AR - i : n - i] for i in range(1, LONG_AR + 1)], axis=2)
            late = rest[:, LONG_AR:]
            shocks = np.hstack([np.zeros((len(rest), LONG_AR)), late - (lags @ _regressed(lags, late)[:, :, None])[:, :, 0]])
            design = np.stack([rest[:, LONG_AR - 1 : n - 1], shocks[:, LONG_AR - 1 : n - 1]], axis=2)
            out.append(np.clip(_regressed(design, late), -0.99, 0.99))
        return np.array(out)

    def fitted(self) -> tuple[np.ndarray, np.ndarray]:
        """phi and theta (end, series), searched as ``fitted`` does."""
        axis = np.linspace(-WIDEST, WIDEST, GRID)
        grid = np.stack(np.meshgrid(axis, axis, indexing="ij"), axis=-1).reshape(-1, 2)
        shape = (len(self.ends), self.steps.shape[1])
        surface = self._grid(axis).swapaxes(2, 3)
        wide = np.pad(surface, ((0, 0), (0, 0), (1, 1), (1, 1)), constant_values=-np.inf)
        beside = [wide[:, :, 1 + a : 1 + a + GRID, 1 + b : 1 + b + GRID] for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b]
        tops = np.where(surface >= np.max(beside, axis=0), surface, -np.inf).reshape(*shape, -1)
        order = np.argsort(-tops, axis=2, kind="stable")[:, :, :TOPS]
        guess = np.arctanh(self.two_stage())[:, :, None]
        found = np.take_along_axis(tops, order, axis=2) > -np.inf
        at = np.concatenate([np.where(found[..., None], grid[order], guess), guess], axis=2)  # end, series, start, coefficient
        around = np.array(AROUND)
        size = np.full(at.shape[:3], 0.5 * (axis[1] - axis[0]))
        middle = [x[..., None] for x in self._sums_at(np.clip(at[..., 1], -LIMIT, LIMIT))]
        for _ in range(REFINEMENTS):
            near = np.clip(at[..., None] + size[..., None, None] * around, -LIMIT, LIMIT)  # ..., coefficient, step
            beside = self._sums_at(near[:, :, :, 1, 1:].reshape(*shape, -1))
            sums = [np.concatenate([x, y.reshape(*x.shape[:-1], 2)], axis=-1) for x, y in zip(middle, beside)]  # the middle is known
            phi = np.repeat(np.tanh(near[:, :, :, 0])[:, :, :, None], 3, axis=3).reshape(*shape, -1, 3)
            theta = np.tanh(near[:, :, :, 1]).reshape(*shape, -1)
            values = self._likelihood(self.ends[:, None, None], theta, phi, *(x.reshape(len(x), *theta.shape) for x in sums)).reshape(*at.shape[:3], 9)
            best = values.argmax(axis=3)
            at = np.stack([np.take_along_axis(near[:, :, :, c], b[..., None], axis=3)[..., 0] for c, b in ((0, best % 3), (1, best // 3))], axis=3)
            middle = [np.take_along_axis(x, (best // 3)[None, ..., None], axis=-1) for x in sums]
            size = np.where(best == 0, size * SHRINK, size)  # the middle is tried first
        if not np.isfinite(values).all():
            raise ValueError("likelihood is not finite")
        winner = values.max(axis=3).argmax(axis=2)
        phi, theta = np.moveaxis(np.tanh(np.take_along_axis(at, winner[..., None, None], axis=2)[:, :, 0]), 2, 0)
        return phi, theta


def _chebyshev(x: np.ndarray) -> np.ndarray:
    """The first PLACES Chebyshev polynomials (PLACES, len(x))."""
    terms = np.empty((PLACES, len(x)))
    terms[0], terms[1] = 1, x
    twice = 2 * x
    for i in range(2, PLACES):
        np.multiply(twice, terms[i - 1], out=terms[i])
        terms[i] -= terms[i - 2]
    return terms


def _regressed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least-squares weights (s, k) of y (s, n) on x (s, n, k); the smallest where they are not unique."""
    turned = x.transpose(0, 2, 1)
    return (np.linalg.pinv(turned @ x, hermitian=True) @ (turned @ y[:, :, None]))[:, :, 0]


def forecasts_together(y: np.ndarray, waves: np.ndarray, origins: list[int]) -> np.ndarray:
    """``forecasts`` of each row of y (s x n) at each origin (ascending): s x origins."""
    step_waves, ends = np.diff(waves[: origins[-1] + 1], axis=0), [i - 1 for i in origins]
    out = []
    for part in np.array_split(y, min(len(y), -(-len(y) * len(ends) // TOGETHER))):
        steps = np.diff(part[:, : origins[-1]])
        columns = np.concatenate([np.repeat(step_waves[: steps.shape[1], None], len(part), axis=1), steps.T[:, :, None]], axis=2)
        phi, theta = Together(step_waves, steps, ends).fitted()
        errors, variances = innovations(np.tile(columns, (1, len(ends), 1)), phi.ravel(), theta.ravel())
        values = []
        for e, n in enumerate(ends):
            mine = slice(e * len(part), (e + 1) * len(part))
            own, spread = errors[mine, :n], variances[mine, :n]
            weights = profile(*moments(own, spread, [n])[0])[1]
            rest = columns[n - 1, :, -1] - (columns[n - 1, :, :-1] * weights).sum(axis=1)
            shock = own[:, -1, -1] - (own[:, -1, :-1] * weights).sum(axis=1)
            values.append(part[:, n] + weights @ step_waves[n] + phi[e] * rest + theta[e] / spread[:, -1] * shock)
        out.append(np.array(values).T)
    return np.vstack(out)


def dense_likelihood(columns: np.ndarray, phi: float, theta: float) -> float:
    """What ``profiles`` gives for one process, from the full covariance matrix: a check, cubic in the length."""
    n = len(columns)
    covariance = np.full(n, (phi + theta) * (1 + phi * theta) / (1 - phi**2)) * np.concatenate([[1.0], phi ** np.arange(n - 1)])
    covariance[0] = (1 + 2 * phi * theta + theta**2) / (1 - phi**2)
    full = covariance[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
    products = columns.T @ np.linalg.solve(full, columns)
    return float(profile(n, products[None], np.array([np.linalg.slogdet(full)[1]]))[0][0])


def covariance_likelihoods(columns: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """What ``dense_likelihood`` gives for each of s processes of n x s x k columns, whose first k - 1 they share.

    The covariance matrix of equal steps is taken apart by its whole first row (Levinson and Durbin): each value less its best
    prediction from all values before it, whose weights follow from those of the step before.
    """
    n, s, k = columns.shape
    backwards = columns[::-1]
    waves, steps = np.ascontiguousarray(backwards[:, 0, :-1]), np.ascontiguousarray(backwards[:, :, -1].T)
    lags = np.arange(n - 1, -1, -1)
    covariance = ((phi + theta) * (1 + phi * theta) / (1 - phi**2))[:, None] * phi[:, None] ** np.maximum(lags - 1, 0)
    covariance[:, -1] = (1 + 2 * phi * theta + theta**2) / (1 - phi**2)
    errors, variances, weights = np.empty((s, n, k)), np.empty((s, n)), np.zeros((s, n))
    errors[:, 0], variances[:, 0] = columns[0], covariance[:, -1]
    for t in range(1, n):
        known = weights[:, : t - 1]  # of the values 1, 2, ... steps back
        new = (covariance[:, n - 1 - t] - np.einsum("st,st->s", known, covariance[:, n - t : -1])) / variances[:, t - 1]
        known -= new[:, None] * known[:, ::-1]
        weights[:, t - 1] = new
        variances[:, t] = variances[:, t - 1] * (1 - new**2)
        errors[:, t, :-1] = columns[t, 0, :-1] - weights[:, :t] @ waves[n - t :]
        errors[:, t, -1] = columns[t, :, -1] - np.einsum("st,st->s", weights[:, :t], steps[:, n - t :])
    return profile(*moments(errors, variances, [n])[0])[0]


def optima(y: np.ndarray, waves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``optimum`` of each whole row of y (s x n), found and checked together."""
    exact, best = [], []
    step_waves = np.diff(waves[: y.shape[1]], axis=0)
    for part in np.array_split(np.diff(y), -(-len(y) // TOGETHER)):
        columns = np.concatenate([np.repeat(step_waves[:, None], len(part), axis=1), part.T[:, :, None]], axis=2)
        search = Together(step_waves, part, [part.shape[1]])
        phi, theta = (c[0] for c in search.fitted())
        value, guess = (profile(*moments(*innovations(columns, *c), [len(columns)])[0])[0] for c in ((phi, theta), search.two_stage()[0].T))
        room = 1e-6 * (1 + np.abs(value))
        exact.append(np.abs(covariance_likelihoods(columns, phi, theta) - value) <= room)
        best.append(value >= guess - room)
    return np.concatenate(exact), np.concatenate(best)


def optimum(y: np.ndarray, waves: np.ndarray) -> tuple[bool, bool]:
    """Whether the fit of a whole history has the likelihood of its covariance matrix,
    and none below the two-stage estimate's."""
    columns = np.column_stack([np.diff(waves[: len(y)], axis=0), np.diff(y)])
    value, phi, theta = fitted(columns, [len(columns)])[0]
    guess = profiles(columns, *(np.array([c]) for c in two_stage(columns[:, -1], columns[:, :-1])))[0]
    room = 1e-6 * (1 + abs(value))
    return abs(dense_likelihood(columns, phi, theta) - value) <= room, value >= guess - room


def forecasts(y: np.ndarray, waves: np.ndarray, origins: list[int]) -> list[float]:
    """For each origin i, the value at i from y[:i] and the waves (n x k) up to i."""
    last = max(origins)
    ends = sorted({i - 1 for i in origins})
    step_waves, steps = np.diff(waves[: last + 1], axis=0), np.diff(y[:last])
    columns = np.column_stack([step_waves[: len(steps)], steps])
    found = dict(zip(ends, fitted(columns, ends)))
    out = []
    for i in origins:
        n = i - 1
        _, phi, theta = found[n]
        errors, variances = innovations(columns[:n], np.array([phi]), np.array([theta]))
        weights = profile(*moments(errors, variances, [n])[0])[1][0]
        rest = columns[n - 1, -1] - columns[n - 1, :-1] @ weights
        shock = errors[0, -1, -1] - errors[0, -1, :-1] @ weights
        out.append(y[i - 1] + step_waves[n] @ weights + phi * rest + theta / variances[0, -1] * shock)
    return out


def _least_squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.linalg.lstsq(x, y, rcond=None)[0]
