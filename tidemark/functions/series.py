"""Two models of a daily series with a weekly season, each fitted by maximum likelihood: exponential smoothing and a seasonal ARIMA.

Both are linear in what isn't searched (starting states; effects of outside variables), so those come from least squares for every point
of the search. What is left is a box of three or four numbers, searched by deterministic steps whose trial points run side by side."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

WEEK = 7
#: Two-sided normal quantile of an 80 % interval.
Z80 = 1.2815515655446004


def compass(loss: Callable[[np.ndarray], np.ndarray], starts: np.ndarray, step: float = 0.25, least: float = 1 / 256, rounds: int = 60) -> np.ndarray:
    """The point of the unit box with the least loss that steps along the axes find from the given starts. loss takes points
    (rows) and is asked for all trial points of all starts at once; a start's step is halved when none of its points is better."""
    at, steps = np.array(starts, float), np.full(len(starts), step)
    found = loss(at)
    ways = np.concatenate([np.eye(at.shape[1]), -np.eye(at.shape[1])])
    for _ in range(rounds):
        if (steps <= least).all():
            break
        trial = np.clip(at[:, None, :] + steps[:, None, None] * ways, 0, 1)
        got = loss(trial.reshape(-1, at.shape[1])).reshape(len(at), len(ways))
        best = got.argmin(1)
        better = got[np.arange(len(at)), best] < found - 1e-12 * np.abs(found)
        at[better] = trial[np.arange(len(at)), best][better]
        found = np.where(better, got.min(1), found)
        steps = np.where(better, steps, steps / 2)
    return at[found.argmin()]


def least_squares(base: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each point p: x that makes base[:, p] + by[:, p] @ x shortest, and the sum of squares left."""
    gram, cross = np.einsum("npi,npj->pij", by, by), np.einsum("npi,np->pi", by, base)
    x = -np.einsum("pij,pj->pi", np.linalg.pinv(gram, rcond=1e-9, hermitian=True), cross)
    return x, np.einsum("np,np->p", base, base) + np.einsum("pi,pi->p", x, cross)


def smoothing_parameters(points: np.ndarray) -> tuple[np.ndarray, ...]:
    """alpha, beta (below alpha), gamma (below 1 - alpha) and damping (0.8 to 0.995) of points in the unit box."""
    alpha = 0.001 + 0.998 * points[:, 0]
    return alpha, alpha * points[:, 1], (1 - alpha) * points[:, 2], 0.8 + 0.195 * points[:, 3]


def smooth(y: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Errors (day, point, 10) and last states (point, 10, 9): column 0 from states of 0, the other nine the effect of one
    unit of level, trend and each weekday at the start."""
    alpha, beta, gamma, phi = (v[:, None] for v in smoothing_parameters(points))
    n = len(points)
    level, trend, season = np.zeros((n, 10)), np.zeros((n, 10)), np.zeros((WEEK, n, 10))
    level[:, 1] = trend[:, 2] = 1.0
    for k in range(WEEK):
        season[k, :, 3 + k] = 1.0
    errors, seen = np.empty((len(y), n, 10)), np.zeros((n, 10))
    for t, value in enumerate(y):
        seen[:, 0] = value
        run, ahead = phi * trend, season[t % WEEK]
        e = seen - (level + run + ahead)
        level = level + run + alpha * e
        trend = run + beta * e
        season[t % WEEK] = ahead + gamma * e
        errors[t] = e
    return errors, np.concatenate([np.stack([level, trend], 2), season.transpose(1, 2, 0)], 2)


def ets(y: np.ndarray, horizon: int) -> np.ndarray:
    """Additive damped trend and weekly season: parameters and starting states of the greatest likelihood (with Gaussian
    errors of one variance that is the least sum of squared one-step errors). Fewer than two weeks: the mean, of nothing 0."""
    return ets_fit(y, horizon)[0]


def ets_fit(y: np.ndarray, horizon: int) -> tuple[np.ndarray, dict]:
    """The forecast, and alpha, beta, gamma, phi, sse."""
    if len(y) < 2 * WEEK:
        return np.full(horizon, y.mean() if len(y) else 0.0), {}
    shift = y.mean()

    def loss(points: np.ndarray) -> np.ndarray:
        errors = smooth(y - shift, points)[0]
        return least_squares(errors[:, :, 0], errors[:, :, 1:])[1]

    best = compass(loss, np.array([[0.1, 0.1, 0.1, 0.8], [0.4, 0.1, 0.1, 0.8], [0.02, 0.02, 0.02, 0.95]]))[None]
    errors, last = smooth(y - shift, best)
    x, sse = least_squares(errors[:, :, 0], errors[:, :, 1:])
    state = last[0, 0] + x[0] @ last[0, 1:]
    alpha, beta, gamma, phi = (float(v[0]) for v in smoothing_parameters(best))
    made = shift + state[0] + np.cumsum(phi ** np.arange(1, horizon + 1)) * state[1] + state[2:][(len(y) + np.arange(horizon)) % WEEK]
    return made, {"alpha": alpha, "beta": beta, "gamma": gamma, "phi": phi, "sse": float(sse[0])}


def lagged(x: np.ndarray, coefficients: dict[int, np.ndarray]) -> np.ndarray:
    """x (day, point, column) less the sum of coefficient times x so many days before; from the longest lag on."""
    top = max(coefficients)
    out = x[top:].copy()
    for lag, c in coefficients.items():
        out -= c[None, :, None] * x[top - lag : len(x) - lag]
    return out


def innovations(w: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Of columns w (day, column): what is left of each after the weekly and daily autoregression and the moving average,
    given the first eight days, for each point (phi, seasonal phi, theta)."""
    phi, weekly, theta = (0.98 * (2 * points - 1)).T
    out = lagged(np.repeat(w[:, None, :], len(points), 1), {1: phi, WEEK: weekly, WEEK + 1: -phi * weekly})
    for t in range(1, len(out)):
        out[t] -= theta[:, None] * out[t - 1]
    return out


def psi_weights(phi: float, weekly: float, theta: float, horizon: int) -> np.ndarray:
    """Effect of one innovation on the level so many days later, the differences summed up."""
    ar = np.convolve(np.convolve([1, -phi], [1] + [0] * (WEEK - 1) + [-weekly]), [1, -1])
    out = np.zeros(horizon)
    for j in range(horizon):
        out[j] = (j == 0) + theta * (j == 1) - sum(ar[i] * out[j - i] for i in range(1, min(j, len(ar) - 1) + 1))
    return out


def sarima(y: np.ndarray, horizon: int, outside: np.ndarray | None = None, ahead: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, low and high (80 %) of (1,1,1)(1,0,0) of period 7, by conditional least squares. outside: columns known for each
    day of y, ahead: the same for the days to come. Too short to fit (six weeks): the last value, no width."""
    return sarima_fit(y, horizon, outside, ahead)[:3]


def sarima_fit(y: np.ndarray, horizon: int, outside: np.ndarray | None = None, ahead: np.ndarray | None = None) -> tuple:
    """sarima, and phi, weekly, theta, effects (of outside), sigma2."""
    w = np.diff(y)
    if len(w) < 6 * WEEK:
        flat = np.full(horizon, y[-1] if len(y) else 0.0)
        return flat, flat, flat, {}
    change = np.diff(outside, axis=0) if outside is not None else np.empty((len(w), 0))
    columns = np.concatenate([w[:, None], -change], 1)

    def left(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        e = innovations(columns, points)
        return least_squares(e[:, :, 0], e[:, :, 1:]) if columns.shape[1] > 1 else (np.empty((len(points), 0)), np.einsum("np,np->p", e[:, :, 0], e[:, :, 0]))

    best = compass(lambda p: left(p)[1], np.array([[0.5, 0.5, 0.5], [0.6, 0.8, 0.2], [0.7, 0.6, 0.1], [0.4, 0.9, 0.4]]))[None]
    effects, sse = left(best)
    e = innovations(columns, best)[:, 0]
    e = e[:, 0] + e[:, 1:] @ effects[0]
    phi, weekly, theta = (float(v) for v in 0.98 * (2 * best[0] - 1))
    noise, last = list(w - change @ effects[0]), float(e[-1])
    for _ in range(horizon):
        noise.append(phi * noise[-1] + weekly * noise[-WEEK] - phi * weekly * noise[-WEEK - 1] + theta * last)
        last = 0.0
    steps = np.array(noise[len(w) :])
    if outside is not None and outside.shape[1]:
        steps = steps + np.diff(np.concatenate([outside[-1:], ahead]), axis=0) @ effects[0]
    mean = y[-1] + np.cumsum(steps)
    sigma2 = float(sse[0]) / max(1, len(e) - 3 - columns.shape[1] + 1)
    width = Z80 * np.sqrt(sigma2 * np.cumsum(psi_weights(phi, weekly, theta, horizon) ** 2))
    return mean, mean - width, mean + width, {"phi": phi, "weekly": weekly, "theta": theta, "effects": effects[0], "sigma2": sigma2}
