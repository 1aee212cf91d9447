"""Seasonal ARIMA with orders: residuals, fit, forecasts and intervals."""

from __future__ import annotations

import numpy as np
import pytest

from playlens.operators import sarima, seasonal
from test_selection_and_storage import make_series

KEY, T = ["key"], "count_months"


def plain_sum(w, ar, sar, ma, sma, season):
    """The objective straight from the equation, one value at a time."""
    lost, e = len(ar) + season * len(sar), {}

    def value(t):
        total = 0.0
        for i, a in enumerate([1.0, *[-v for v in ar]]):
            for k, b in enumerate([1.0, *[-v for v in sar]]):
                total += a * b * w[t - i - season * k]
        for i, a in enumerate([1.0, *ma]):
            for k, b in enumerate([1.0, *sma]):
                if i or k:
                    total -= a * b * e.get(t - i - season * k, 0.0)
        return total

    for t in range(lost, len(w)):
        e[t] = value(t)
    return sum(v * v for v in e.values())


def nelder_mead(f, start, rounds=1500):
    """A derivative-free search, independent of the operator's."""
    n = len(start)
    points = [np.array(start)] + [np.array(start) + 0.2 * np.eye(n)[i] for i in range(n)]
    scored = sorted(((f(p), tuple(p)) for p in points))
    for _ in range(rounds):
        centre = np.mean([p for _, p in scored[:-1]], axis=0)
        worst = np.array(scored[-1][1])
        trial = centre + (centre - worst)
        value = f(trial)
        if value < scored[0][0]:
            far = centre + 2 * (centre - worst)
            trial, value = min(((f(far), tuple(far)), (value, tuple(trial))))[::-1]
        elif value >= scored[-2][0]:
            trial = centre + 0.5 * (worst - centre)
            value = f(trial)
            if value >= scored[-1][0]:
                best = np.array(scored[0][1])
                scored = sorted(((f(q), tuple(q)) for q in [best + 0.5 * (np.array(p) - best) for _, p in scored]))
                continue
        scored = sorted([*scored[:-1], (value, tuple(trial))])
    return np.array(scored[0][1]), scored[0][0]


def simulated(seed, n, ar=0.5, ma=-0.3, sma=-0.5):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 40)
    w = np.zeros(n + 40)
    for t in range(13, n + 40):
        w[t] = ar * w[t - 1] + e[t] + ma * e[t - 1] + sma * e[t - 12] + ma * sma * e[t - 13]
    y = np.zeros(n + 40)
    for t in range(13, n + 40):
        y[t] = w[t] + y[t - 1] + y[t - 12] - y[t - 13]
    return 100 + y[40:]


@pytest.mark.parametrize("order,seasonal_order", [((1, 1, 1), (1, 1, 1, 12)), ((2, 0, 1), (0, 1, 1, 4)), ((0, 1, 2), (0, 0, 0, 0)), ((1, 0, 0), (1, 0, 0, 12))])
def test_fit_equals_another_optimiser(order, seasonal_order):
    orders = sarima.Orders(order, seasonal_order)
    y = simulated(0, 70)
    w = np.diff(y) if not orders.d else y  # a stationary enough series for each order
    w = orders.differenced(w)
    w = w / np.sqrt(np.mean(w * w))

    def objective(free):
        return plain_sum(w, *orders.split(orders.bounded(np.asarray(free))), orders.season)

    params, total = sarima.minimise(orders, w)
    assert np.isclose(total, plain_sum(w, *orders.split(params), orders.season))
    other = min((nelder_mead(objective, s, 150) for s in (np.zeros(orders.k), np.full(orders.k, 0.4))), key=lambda r: r[1])
    assert total <= other[1] * (1 + 1e-6)


@pytest.mark.parametrize("size", [1, 2, 3])
def test_polynomials_stay_stationary(size):
    rng = np.random.default_rng(size)
    orders = sarima.Orders((size, 0, size), (0, 0, 0, 0))
    for _ in range(50):
        ar, _, ma, _ = orders.split(orders.bounded(rng.normal(scale=3, size=2 * size)))
        assert np.abs(np.roots([1, *-ar])).max() < 1 and np.abs(np.roots([1, *ma])).max() < 1


def test_forecast_continues_the_equation():
    """Each forecast is the value that makes the next residual zero."""
    orders = sarima.Orders((1, 1, 1), (1, 1, 1, 12))
    y = simulated(3, 80)
    found = sarima.fit_series(y, orders, 15)
    longer = orders.differenced(np.concatenate([y, found["forecast"]]))
    residuals = orders.residuals(longer, found["params"][None])[0]
    assert np.allclose(residuals[-15:], 0, atol=1e-8)


def test_intervals_cover_simulated_futures():
    """The standard errors are those of futures drawn from the fitted model."""
    orders = sarima.Orders((1, 1, 1), (1, 1, 1, 12))
    y = simulated(4, 90)
    found = sarima.fit_series(y, orders, 14)
    w = orders.differenced(y)
    e = orders.residuals(w, found["params"][None])[0]
    sigma = np.sqrt(e @ e / (len(e) - orders.k))
    ar, ma = orders.polynomials(found["params"])
    rng, n, ahead = np.random.default_rng(0), 4000, 14
    shocks = np.concatenate([np.tile(np.concatenate([np.zeros(orders.lost), e]), (n, 1)), sigma * rng.normal(size=(n, ahead))], axis=1)
    past_w, past_y = np.tile(w, (n, 1)), np.tile(y, (n, 1))
    for h in range(ahead):
        at = len(w) + h
        value = sum(b * shocks[:, at - j] for j, b in enumerate(ma)) - sum(a * past_w[:, at - i] for i, a in enumerate(ar) if i)
        past_w = np.column_stack([past_w, value])
        past_y = np.column_stack([past_y, value - sum(c * past_y[:, -i] for i, c in enumerate(orders.difference) if i)])
    drawn = past_y[:, len(y) :]
    assert np.allclose(drawn.mean(axis=0), found["forecast"], atol=5 * found["error"].max() / np.sqrt(n))
    assert np.allclose(drawn.std(axis=0), found["error"], rtol=0.06)


def test_closed_form_orders_agree(spark):
    """(1,1,0)(0,1,0)12 has a closed form, in units of any size."""
    values = {"a": simulated(1, 60).tolist(), "b": (1e6 * simulated(2, 45)).tolist()}
    df = make_series(spark, values)
    want = {(r["key"], r["t"]): r["forecast"] for r in seasonal.seasonal_forecast(df, KEY, T, "y", periods=14).collect()}
    got = sarima.seasonal_arima_forecast(df, KEY, T, "y", (1, 1, 0), (0, 1, 0, 12), periods=14).collect()
    assert len(got) == len(want) == 28
    for r in got:
        assert np.isclose(r["forecast"], want[r["key"], r["t"]], rtol=1e-9) and r["lower"] < r["forecast"] < r["upper"]


def test_odd_series(spark):
    df = make_series(spark, {"short": [1.0] * 20, "flat": [3.0] * 40, "holes": [None if i % 9 == 4 else float(i % 12 + 0.1 * i) for i in range(60)]})
    rows = sarima.seasonal_arima_forecast(df, KEY, T, "y").collect()
    short = [r for r in rows if r["key"] == "short"]
    assert len(short) == 1 and short[0]["forecast"] is None and short[0]["reason"] == "fewer than 31 points"
    flat = [r for r in rows if r["key"] == "flat"]
    assert [(r["forecast"], r["lower"], r["upper"]) for r in flat] == [(3.0, 3.0, 3.0)] * 3
    assert sum(r["key"] == "holes" and r["forecast"] is not None for r in rows) == 3
    assert sarima.seasonal_arima(df.where("false"), KEY, T, "y").count() == 0
    with pytest.raises(ValueError):
        sarima.Orders((1, -1, 0), (0, 0, 0, 0))
