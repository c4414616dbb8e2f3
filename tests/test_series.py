"""The two series models against plain recursions and generated series; boosted trees against enumeration."""

from itertools import combinations, product
from math import factorial

import numpy as np

from tidemark.functions import boosting, series

WEEK = np.array([0, 5, 8, 10, 30, 40, 10.0]) - 14.7


def smooth_series(n, alpha, beta, gamma, phi, seed=1):
    g, level, trend, season, out = np.random.default_rng(seed), 100.0, 0.1, WEEK.copy(), []
    for t in range(n):
        e = g.normal(0, 3)
        out.append(level + phi * trend + season[t % 7] + e)
        level, trend = level + phi * trend + alpha * e, phi * trend + beta * e
        season[t % 7] += gamma * e
    return np.array(out)


def one_step_sse(y, alpha, beta, gamma, phi, level, trend, season):
    season, sse = list(season), 0.0
    for t, value in enumerate(y):
        e = value - (level + phi * trend + season[t % 7])
        sse += e * e
        level, trend = level + phi * trend + alpha * e, phi * trend + beta * e
        season[t % 7] += gamma * e
    return sse


def test_smoothing_is_no_worse_than_a_grid_and_finds_what_made_the_series():
    for seed, true in ((1, (0.3, 0.02, 0.1, 0.97)), (2, (0.1, 0.005, 0.05, 0.9))):
        y = smooth_series(700, *true, seed=seed)
        _, fit = series.ets_fit(y, 5)
        grid = min(one_step_sse(y, a, a * b, g, p, y[:7].mean(), 0.0, y[:7] - y[:7].mean()) for a, b, g, p in product((0.05, 0.1, 0.2, 0.4), (0.01, 0.05), (0.02, 0.05, 0.1), (0.9, 0.98)))
        assert fit["sse"] <= grid and fit["sse"] <= one_step_sse(y, *true, 100.0, 0.1, WEEK) * 1.001
        assert abs(fit["alpha"] - true[0]) < 0.12 and abs(fit["gamma"] - true[2]) < 0.08


def test_smoothing_errors_are_those_of_a_plain_recursion():
    y, point = smooth_series(60, 0.3, 0.02, 0.1, 0.97), np.array([[0.3, 0.2, 0.1, 0.5]])
    errors, last = series.smooth(y, point)
    alpha, beta, gamma, phi = (float(v[0]) for v in series.smoothing_parameters(point))
    x = np.array([90.0, 0.5, *WEEK])
    assert abs(((errors[:, 0, 0] + errors[:, 0, 1:] @ x) ** 2).sum() - one_step_sse(y, alpha, beta, gamma, phi, 90.0, 0.5, WEEK)) < 1e-6


def test_short_series():
    assert list(series.ets(np.array([1.0, 2.0, 3.0]), 2)) == [2.0, 2.0] and list(series.ets(np.array([]), 2)) == [0.0, 0.0]
    mean, low, high = series.sarima(np.arange(20.0), 3)
    assert list(mean) == list(low) == list(high) == [19.0] * 3
    assert list(series.sarima(np.array([]), 1)[0]) == [0.0]
    flat = series.sarima(np.full(200, 7.0), 4)
    assert np.allclose(flat, 7.0) and np.allclose(series.ets(np.full(200, 7.0), 4), 7.0)


def arima_series(n=900, phi=0.3, weekly=0.5, theta=-0.4, effect=15.0):
    g = np.random.default_rng(1)
    e, w, x = g.normal(0, 2, n + 50), np.zeros(n + 50), (g.random(n + 50) < 0.05).astype(float)
    for t in range(8, n + 50):
        w[t] = phi * w[t - 1] + weekly * w[t - 7] - phi * weekly * w[t - 8] + e[t] + theta * e[t - 1]
    return 200 + np.cumsum(w)[50:] + effect * x[50:], x[50:, None]


def test_sarima_finds_what_made_the_series_and_its_bands_widen():
    y, x = arima_series()
    mean, low, high, fit = series.sarima_fit(y, 30, x, np.zeros((30, 1)))
    assert abs(fit["phi"] + fit["theta"] + 0.1) < 0.1 and abs(fit["weekly"] - 0.5) < 0.1 and abs(fit["effects"][0] - 15) < 1 and abs(fit["sigma2"] - 4) < 0.6
    assert (np.diff(high - low) > 0).all() and np.allclose(high + low, 2 * mean)
    lifted = series.sarima(y, 30, x, np.ones((30, 1)))[0]
    assert np.allclose(lifted - mean, fit["effects"][0])


def test_sarima_is_a_plain_recursion():
    y, _ = arima_series(300)
    mean, low, high, fit = series.sarima_fit(y, 12)
    phi, weekly, theta = fit["phi"], fit["weekly"], fit["theta"]
    w, e = list(np.diff(y)), [0.0] * 8
    for t in range(8, len(w)):
        e.append(w[t] - phi * w[t - 1] - weekly * w[t - 7] + phi * weekly * w[t - 8] - theta * e[t - 1])
    level, made = y[-1], []
    for h in range(12):
        w.append(phi * w[-1] + weekly * w[-7] - phi * weekly * w[-8] + theta * (e[-1] if h == 0 else 0.0))
        level += w[-1]
        made.append(level)
    assert np.allclose(mean, made)
    # an innovation put into the recursion has the effect that the psi weights say
    pulse, noise = [0.0] * 8 + [0.0] * 12, [0.0] * 8 + [1.0] + [0.0] * 11
    for t in range(8, 20):
        pulse[t] = phi * pulse[t - 1] + weekly * pulse[t - 7] - phi * weekly * pulse[t - 8] + noise[t] + theta * noise[t - 1]
    psi = np.cumsum(pulse[8:])
    assert np.allclose(series.psi_weights(phi, weekly, theta, 12), psi)
    assert np.allclose(high - mean, series.Z80 * np.sqrt(fit["sigma2"] * np.cumsum(psi**2)))


def rows(n, seed=3):
    g = np.random.default_rng(seed)
    x = g.normal(size=(n, 4))
    x[g.random(x.shape) < 0.1] = np.nan
    return x, np.nan_to_num(x[:, 0]) * 3 + np.where(np.nan_to_num(x[:, 1]) > 0, 5.0, 0.0) * np.sign(np.nan_to_num(x[:, 2])) + g.normal(size=n) * 0.3


def expected(trees, t, codes, known, node=0):
    """The expectation of one tree when only some features are known: others follow the training rows."""
    inner = trees.feature.shape[1]
    if node >= inner:
        return trees.leaf[t, node - inner]
    left, right = 2 * node + 1, 2 * node + 2
    f = trees.feature[t, node]
    if f in known:
        return expected(trees, t, codes, known, right if codes[f] > trees.cut[t, node] else left)
    whole = trees.cover[t, node]
    return sum(trees.cover[t, c] / whole * expected(trees, t, codes, known, c) for c in (left, right)) if whole else 0.0


def test_contributions_equal_enumeration():
    x, y = rows(400)
    for settings in (dict(step=0.3), dict(step=0.3, absolute=True, l2=1.0)):
        trees = boosting.fit(x, y, 6, 3, **settings)
        got, base = boosting.contributions(trees, x[:12])
        assert np.allclose(got.sum(1) + base, boosting.predict(trees, x[:12]))
        codes = boosting.binned(x, trees.edges)
        for i in range(12):
            v = {s: trees.base + sum(expected(trees, t, codes[i], s) for t in range(6)) for k in range(5) for s in combinations(range(4), k)}
            assert abs(v[()] - base) < 1e-9
            for f in range(4):
                rest = [k for k in range(4) if k != f]
                value = sum(factorial(len(s)) * factorial(3 - len(s)) / 24 * (v[tuple(sorted((*s, f)))] - v[s]) for k in range(4) for s in combinations(rest, k))
                assert abs(value - got[i, f]) < 1e-9


def test_trees_learn_and_predict_row_by_row():
    x, y = rows(3000)
    trees = boosting.fit(x, y, 60, 4, 0.1)
    made = boosting.predict(trees, x)
    assert 1 - ((made - y) ** 2).mean() / y.var() > 0.95
    assert np.allclose(made[:5], [boosting.predict(trees, x[i : i + 1])[0] for i in range(5)])
    assert np.allclose(boosting.predict(boosting.fit(x[:1], y[:1], 3, 2, 0.1), x[:3]), y[0])
