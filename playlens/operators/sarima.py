"""Seasonal ARIMA with the caller's orders (T5), fitted per key.

``order`` is (p, d, q) and ``seasonal_order`` (P, D, Q, season). The series is
differenced d times at lag 1 and D times at the season, giving w; the model is

    phi(B) Phi(B^s) w_t = theta(B) Theta(B^s) e_t

without a constant. It is fitted by conditional least squares: residuals before
p + s P are zero, and the sum of squared residuals over the rest is minimised by
Levenberg-Marquardt (Gauss-Newton steps that fall back to shorter ones) from the
best of a fixed grid of starts. Each of the four polynomials is kept stationary
or invertible by searching over its partial autocorrelations. The scale of the series doesn't matter: w is fitted in units of
its root mean square.

Forecasts follow the difference equation with future residuals zero; intervals
come from the psi weights of the whole (differenced) model and the residual
variance SSE / (residuals - parameters). Every key is fitted in one task: a
series is bounded by its months, and Spark deals out the keys.

Defined results: rows without a target are left out (lags count present rows);
a key with too few points has one row of NULLs with a ``reason``; a series whose
differences are all zero is continued without error.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

DEFAULT_ORDER, DEFAULT_SEASONAL = (1, 1, 1), (1, 1, 1, 12)
#: Start values of a parameter; runs from the best starts; steps of a run.
STARTS, RUNS, STEPS = (-0.45, 0.0, 0.45), 4, 200
#: Bound of a partial autocorrelation.
INSIDE = 0.9999
Z95 = 1.959963984540054


class Orders:
    """The polynomials of a pair of orders."""

    def __init__(self, order: tuple[int, int, int], seasonal_order: tuple[int, int, int, int]):
        self.p, self.d, self.q = (int(v) for v in order)
        self.sp, self.sd, self.sq, self.season = (int(v) for v in seasonal_order)
        if min(self.p, self.d, self.q, self.sp, self.sd, self.sq) < 0:
            raise ValueError("orders can't be negative")
        if (self.sp or self.sd or self.sq) and self.season < 2:
            raise ValueError("a seasonal order needs a season of 2 or more")
        self.sizes = (self.p, self.sp, self.q, self.sq)
        self.k = sum(self.sizes)
        self.lost = self.p + self.season * self.sp  # values of w without a residual
        difference = np.ones(1)
        for _ in range(self.d):
            difference = np.convolve(difference, [1, -1])
        for _ in range(self.sd):
            difference = np.convolve(difference, [1, *[0] * (self.season - 1), -1])
        self.difference = difference
        self.least = len(difference) - 1 + self.lost + self.k + 1

    def split(self, params: np.ndarray) -> list[np.ndarray]:
        return np.split(params, np.cumsum(self.sizes)[:-1])

    def polynomials(self, params: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Coefficients of the whole autoregressive and moving-average sides."""
        ar, sar, ma, sma = self.split(params)
        long_ar, long_ma = (np.zeros(self.season * n + 1) for n in (self.sp, self.sq))
        long_ar[0] = long_ma[0] = 1
        if self.sp:
            long_ar[self.season :: self.season] = -sar
        if self.sq:
            long_ma[self.season :: self.season] = sma
        return np.convolve([1, *-ar], long_ar), np.convolve([1, *ma], long_ma)

    def bounded(self, free: np.ndarray) -> np.ndarray:
        """Stationary and invertible parameters of unbounded numbers: each
        number gives a partial autocorrelation inside (-1, 1), and the
        recursion over them the coefficients of its polynomial."""
        partial = INSIDE * free / np.sqrt(1 + free * free)
        ar, sar, ma, sma = map(_coefficients, self.split(partial))
        return np.concatenate([ar, sar, -ma, -sma])

    def differenced(self, y: np.ndarray) -> np.ndarray:
        return np.convolve(y, self.difference, mode="valid")

    def residuals(self, w: np.ndarray, params: np.ndarray) -> np.ndarray:
        """One row of conditional residuals for each row of ``params``."""
        sides = [self.polynomials(p) for p in params]
        ar, ma = (np.stack(s) for s in zip(*sides))
        e = np.stack([np.convolve(w, a, mode="valid") for a in ar])
        back = ma.shape[1] - 1
        padded = np.zeros((len(params), back + e.shape[1]))
        lags = ma[:, :0:-1]
        for t in range(e.shape[1]):
            padded[:, back + t] = e[:, t] - (lags * padded[:, t : t + back]).sum(axis=1)
        return padded[:, back:]


def _coefficients(partial: np.ndarray) -> np.ndarray:
    """Autoregressive coefficients of given partial autocorrelations."""
    found = np.empty(0)
    for r in partial:
        found = np.append(found - r * found[::-1], r)
    return found


def minimise(orders: Orders, w: np.ndarray) -> tuple[np.ndarray, float]:
    """Parameters with the least conditional sum of squares, and that sum."""
    if not orders.k:
        return np.zeros(0), float((orders.residuals(w, np.zeros((1, 0))) ** 2).sum())
    wide = STARTS if orders.k <= 4 else (0.0,)
    starts = np.array(list(itertools.product(wide, repeat=orders.k)))
    sums = (orders.residuals(w, np.stack([orders.bounded(s) for s in starts])) ** 2).sum(axis=1)
    runs = [_descend(orders, w, starts[i]) for i in np.argsort(sums, kind="stable")[:RUNS]]
    return min(runs, key=lambda r: r[1])


def _descend(orders: Orders, w: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, float]:
    step, damping = 1e-6, 1e-3
    shifts = np.vstack([np.eye(orders.k), -np.eye(orders.k)]) * step
    at = lambda rows: orders.residuals(w, np.stack([orders.bounded(r) for r in rows]))
    e = at([free])[0]
    total = float(e @ e)
    for _ in range(STEPS):
        moved = at(free + shifts)
        slope = (moved[: orders.k] - moved[orders.k :]).T / (2 * step)
        normal, toward = slope.T @ slope, slope.T @ e
        better = False
        while damping < 1e10 and not better:
            tried = free + np.linalg.lstsq(normal + damping * np.diag(np.maximum(np.diag(normal), 1e-12)), -toward, rcond=None)[0]
            now = at([tried])[0]
            better = float(now @ now) < total
            damping = damping / 4 if better else damping * 4
        if not better:
            break
        gained, free, e, total = total - float(now @ now), tried, now, float(now @ now)
        if gained <= 1e-13 * total:
            break
    return orders.bounded(free), total


def fit_series(y: np.ndarray, orders: Orders, periods: int) -> dict:
    """Parameters, sum of squares, forecasts and their standard errors."""
    w = orders.differenced(y)
    scale = float(np.sqrt(np.mean(w * w))) or 1.0
    params, total = minimise(orders, w / scale)
    e = orders.residuals(w, params[None])[0]
    ar, ma = orders.polynomials(params)
    known_w, known_e, known_y = list(w), [0.0] * len(ma) + list(e), list(y)
    for _ in range(periods):
        known_e.append(0.0)
        value = sum(b * v for b, v in zip(ma[1:], known_e[-2::-1])) - sum(a * v for a, v in zip(ar[1:], known_w[::-1]))
        known_w.append(value)
        known_y.append(value - sum(c * v for c, v in zip(orders.difference[1:], known_y[::-1])))
    whole = np.convolve(ar, orders.difference)
    psi = np.zeros(periods)
    for j in range(periods):
        psi[j] = (ma[j] if j < len(ma) else 0.0) - sum(whole[i] * psi[j - i] for i in range(1, min(j, len(whole) - 1) + 1)) if j else 1.0
    variance = float(e @ e) / max(1, len(e) - orders.k)
    return {
        "params": params,
        "sse": total * scale * scale,
        "n_residuals": len(e),
        "forecast": known_y[len(y) :],
        "error": np.sqrt(variance * np.cumsum(psi**2)),
    }


def seasonal_arima(
    series: DataFrame,
    key_cols: list[str],
    t_col: str,
    y_col: str,
    order: tuple[int, int, int] = DEFAULT_ORDER,
    seasonal_order: tuple[int, int, int, int] = DEFAULT_SEASONAL,
    periods: int = 3,
    z: float = Z95,
) -> DataFrame:
    """Per key ``(keys, ar, seasonal_ar, ma, seasonal_ma, sse, n_residuals,
    forecast, lower, upper, reason)`` as arrays: the fit and its forecasts."""
    if int(periods) < 1:
        raise ValueError("periods must be 1 or more")
    orders = Orders(order, seasonal_order)
    numbers = ["ar", "seasonal_ar", "ma", "seasonal_ma"]
    arrays = lambda names: [StructField(n, ArrayType(DoubleType())) for n in names]
    schema = StructType(
        [series.schema[c] for c in key_cols]
        + arrays(numbers)
        + [StructField("sse", DoubleType()), StructField("n_residuals", LongType())]
        + arrays(["forecast", "lower", "upper"])
        + [StructField("reason", StringType())]
    )
    names = [f.name for f in schema]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        keys = frame[key_cols].iloc[0].tolist()
        y = frame.sort_values("_t", kind="stable")["_y"].dropna().to_numpy(float)
        if len(y) < orders.least:
            row = [*keys, *[None] * (len(names) - len(keys) - 1), f"fewer than {orders.least} points"]
        else:
            found = fit_series(y, orders, int(periods))
            value, error = np.array(found["forecast"]), z * found["error"]
            row = [*keys, *[p.tolist() for p in orders.split(found["params"])], found["sse"], found["n_residuals"]]
            row += [value.tolist(), (value - error).tolist(), (value + error).tolist(), None]
        return pd.DataFrame([row], columns=names)

    rows = series.select(*key_cols, F.col(t_col).alias("_t"), F.col(y_col).cast("double").alias("_y"))
    return rows.groupBy(*key_cols).applyInPandas(run, schema)


def seasonal_arima_forecast(
    series: DataFrame,
    key_cols: list[str],
    t_col: str,
    y_col: str,
    order: tuple[int, int, int] = DEFAULT_ORDER,
    seasonal_order: tuple[int, int, int, int] = DEFAULT_SEASONAL,
    month_col: str = "timestamp_month",
    periods: int = 3,
    value_col: str = "forecast",
    z: float = Z95,
) -> DataFrame:
    """T5: ``(keys, month, t, <value_col>, lower, upper, reason)``, one row a
    step; lower and upper bound the interval of ``z`` standard errors."""
    fitted = seasonal_arima(series, key_cols, t_col, y_col, order, seasonal_order, periods, z)
    last = series.groupBy(*key_cols).agg(F.max(t_col).alias("_T"), F.max(month_col).alias("_last"))
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"l.{c}")) for c in key_cols]
    joined = fitted.alias("f").join(last.alias("l"), same)
    steps = joined.select(*[F.col(f"f.{c}") for c in key_cols], "_T", "_last", "reason", F.posexplode_outer(F.arrays_zip("forecast", "lower", "upper")).alias("_h", "_v"))
    month = F.add_months(F.col("_last").cast("date"), F.col("_h") + 1).cast("timestamp_ntz")
    return steps.select(
        *key_cols,
        month.alias("month"),
        (F.col("_T") + F.col("_h") + 1).cast(IntegerType()).alias("t"),
        F.col("_v.forecast").alias(value_col),
        "_v.lower",
        "_v.upper",
        "reason",
    )
