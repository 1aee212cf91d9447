"""Time-series diagnostics and the seasonal forecast (T1-T6), per key.

Differences, the stationarity test and the forecast are windows partitioned by
the series key and ordered by the month counter; autocorrelations work on the
key's values as one array (a series is bounded by its months). Any number of
series take one job. Lags count rows of the counted series (months present).

Re-aimed piece (see README): the seasonal forecast is SARIMA(1,1,0)(0,1,0)_12
fitted by conditional least squares (closed form), in place of a state-space
maximum-likelihood fit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEASON = 12
MIN_SEASONAL_POINTS = SEASON + 3  # u needs 12 lags, w one more, phi one pair

# --- Fixed values: MacKinnon (2010) response surface for the 5% critical
# --- value of the Dickey-Fuller t statistic, constant and no trend:
# --- tau(T) = b0 + b1/T + b2/T^2 + b3/T^3.
DF_CRIT_5PCT = (-2.86154, -2.8903, -4.234, -40.040)

# --- Fixed values: MacKinnon (1994) approximation of the p-value of the same
# --- statistic: normal CDF of a polynomial in the statistic, by range.
DF_P_MIN, DF_P_STAR, DF_P_MAX = -18.83, -1.61, 2.74
DF_P_SMALL = (2.1659, 1.4412, 0.038269)
DF_P_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)

# --- Fixed values: normal CDF by Abramowitz and Stegun 26.2.17 (error < 7.5e-8).
NORMAL_P = 0.2316419
NORMAL_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)

#: Half-width factor of 95 % confidence bands.
Z95 = 1.959963984540054


def _w(key_cols, t_col):
    return Window.partitionBy(*key_cols).orderBy(F.col(t_col).asc())


def differencing(series: DataFrame, key_cols: list[str], t_col: str, y_col: str, season: int = SEASON) -> DataFrame:
    """Regular (lag 1), seasonal (lag ``season``) and combined differences."""
    w = _w(key_cols, t_col)
    return (
        series.withColumn("_ds", F.col(y_col) - F.lag(y_col, season).over(w))
        .select(
            *key_cols,
            t_col,
            (F.col(y_col) - F.lag(y_col, 1).over(w)).alias("diff_1"),
            (F.col("_ds")).alias("diff_seasonal"),
            (F.col("_ds") - F.lag("_ds", 1).over(w)).alias("diff_both"),
        )
    )


def _correlations(series: DataFrame, key_cols: list[str], t_col: str, y_col: str, nlags: int | None) -> DataFrame:
    """Per key: ``_n`` values, the last lag ``_lim`` and the autocorrelations
    ``_r`` of lags 0.._lim as an array. Without ``nlags`` the last lag follows
    the length: min(ceil(10 log10 n), n div 2). Rows without a value are left
    out."""
    y = F.col(y_col).cast("double")
    listed = series.where(y.isNotNull()).groupBy(*key_cols).agg(
        F.sort_array(F.collect_list(F.struct(F.col(t_col).alias("t"), y.alias("y")))).alias("_s"),
        F.avg(y).alias("_m"),
        F.count(y).cast("int").alias("_n"),
    )
    lim = "least(CAST(ceil(10 * log10(_n)) AS INT), _n div 2)" if nlags is None else str(int(nlags))
    products = (
        "transform(sequence(0, _lim), k -> aggregate(zip_with(slice(_d, 1, _n - k), slice(_d, k + 1, _n - k), "
        "(a, b) -> a * b), 0D, (a, v) -> a + v))"
    )
    found = (
        listed.withColumn("_lim", F.expr(f"CAST(least({lim}, _n - 1) AS INT)"))
        .withColumn("_d", F.expr("transform(_s, s -> s.y - _m)"))
        .withColumn("_c", F.expr(products))
    )
    # An aggregate over the same key keeps the products from being evaluated anew in every later lambda.
    once = found.groupBy(*key_cols).agg(*[F.first(c).alias(c) for c in ("_n", "_lim", "_c")])
    ratios = once.withColumn("_r", F.expr("transform(_c, c -> try_divide(c, _c[0]))"))
    return ratios.select(*key_cols, "_n", "_lim", "_r")


def acf(series: DataFrame, key_cols: list[str], t_col: str, y_col: str, nlags: int | None = None) -> DataFrame:
    """Autocorrelation r_k = sum (y_t - m)(y_{t+k} - m) / sum (y_t - m)^2,
    k = 0..nlags (by default a number of lags that follows the length), and
    the half-width ``band`` of its 95 % confidence band by Bartlett's formula,
    1.96 sqrt((1 + 2 sum_{i<k} r_i^2) / n) (0 at lag 0). Long form
    ``(keys, lag, acf, band)``."""
    band = (
        f"CASE WHEN lag = 0 THEN 0D ELSE {Z95}D * sqrt((1 + 2 * aggregate(slice(_r, 2, lag - 1), 0D, (a, v) -> a + v * v)) / _n) END"
    )
    return (
        _correlations(series, key_cols, t_col, y_col, nlags)
        .select(*key_cols, "_n", "_r", F.posexplode("_r").alias("lag", "acf"))
        .select(*key_cols, "lag", "acf", F.expr(band).alias("band"))
    )


def _durbin_levinson_sql(r: str, nlags: str) -> str:
    """Spark SQL for the PACF array from the autocorrelation array ``r``
    (r[1] = lag 0): Durbin-Levinson as a fold over k = 1..nlags carrying the
    current AR coefficients (``phi``) and the partial autocorrelations."""
    dot_num = f"aggregate(transform(acc.phi, (p, i) -> p * element_at({r}, k - i)), 0D, (s, v) -> s + v)"
    dot_den = f"aggregate(transform(acc.phi, (p, i) -> p * element_at({r}, i + 2)), 0D, (s, v) -> s + v)"
    pkk = f"try_divide(element_at({r}, k + 1) - {dot_num}, 1D - {dot_den})"
    return (
        f"aggregate(sequence(1, {nlags}), "
        "named_struct('phi', cast(array() as array<double>), 'out', cast(array() as array<double>)), "
        f"(acc, k) -> named_struct("
        f"'phi', concat(transform(acc.phi, (p, i) -> p - {pkk} * element_at(acc.phi, k - 1 - i)), array({pkk})), "
        f"'out', concat(acc.out, array({pkk}))), "
        "acc -> acc.out)"
    )


def pacf(series: DataFrame, key_cols: list[str], t_col: str, y_col: str, nlags: int | None = None) -> DataFrame:
    """Partial autocorrelation (Yule-Walker on the biased autocovariances,
    solved by Durbin-Levinson), k = 1..min(nlags, n // 2 - 1), with nlags by
    length as in ``acf``, and the half-width ``band`` = 1.96 / sqrt(n) of its
    95 % confidence band. Long form ``(keys, lag, pacf, band)``."""
    out = _correlations(series, key_cols, t_col, y_col, nlags)
    out = out.withColumn("_k", F.expr("least(_lim, _n div 2 - 1)")).where("_k >= 1")
    out = out.withColumn("_p", F.expr(_durbin_levinson_sql("_r", "CAST(_k AS INT)")))
    return (
        out.select(*key_cols, "_n", F.posexplode("_p").alias("pos", "pacf"))
        .select(*key_cols, (F.col("pos") + 1).cast("int").alias("lag"), "pacf", (F.lit(Z95) / F.sqrt("_n")).alias("band"))
    )


def _polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    out = F.lit(0.0)
    for c in reversed(coefficients):
        out = out * x + F.lit(c)
    return out


def normal_cdf(x: Column) -> Column:
    """The standard normal distribution function."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(NORMAL_P) * F.abs(x))
    tail = F.exp(-x * x / 2) / F.lit((2 * np.pi) ** 0.5) * t * _polynomial(t, NORMAL_B)
    return F.when(x >= 0, F.lit(1.0) - tail).otherwise(tail)


def dickey_fuller_p(statistic: Column) -> Column:
    """The approximate p-value of the Dickey-Fuller t statistic (constant, no trend)."""
    small, large = _polynomial(statistic, DF_P_SMALL), _polynomial(statistic, DF_P_LARGE)
    return (
        F.when(statistic > DF_P_MAX, F.lit(1.0))
        .when(statistic < DF_P_MIN, F.lit(0.0))
        .when(statistic <= DF_P_STAR, normal_cdf(small))
        .when(statistic.isNotNull(), normal_cdf(large))
    )


def _judged(chosen: DataFrame, key_cols: list[str]) -> DataFrame:
    """The test's output from (keys, used_lag, n_obs, adf_statistic)."""
    n = F.col("n_obs").cast("double")
    crit = _polynomial(F.lit(1.0) / n, DF_CRIT_5PCT)
    usable = F.col("n_obs") >= 3
    p = F.when(usable, dickey_fuller_p(F.col("adf_statistic")))
    return chosen.select(
        *key_cols,
        F.col("used_lag").cast("int").alias("used_lag"),
        F.col("n_obs").cast("long").alias("n_obs"),
        F.when(usable, F.col("adf_statistic")).alias("adf_statistic"),
        p.alias("p_value"),
        F.when(usable, crit).alias("critical_5pct"),
        (p < 0.05).alias("is_stationary"),
        F.when(~usable, F.lit("fewer than 3 usable differences"))
        .when(F.col("adf_statistic").isNull(), F.lit("the regression has no unique solution"))
        .alias("reason"),
    )


def _adf_search(y: np.ndarray, max_lag: int | None) -> tuple[int, int, float | None]:
    """(used lag, observations, statistic) of one series: AIC over lags
    0..max_lag on their common sample, the best refitted on its own."""
    n = len(y)
    if max_lag is None:
        max_lag = int(np.ceil(12 * (n / 100) ** 0.25)) if n else 0
    max_lag = max(0, min(max_lag, n // 2 - 2))
    dy = np.diff(y)

    def fit(lags: int, skip: int) -> tuple[float, int, float | None]:
        rows = np.arange(skip, len(dy))
        x = np.column_stack([y[rows], *[dy[rows - i] for i in range(1, lags + 1)], np.ones(len(rows))])
        if len(rows) <= x.shape[1]:
            return np.inf, len(rows), None
        beta, _, rank, _ = np.linalg.lstsq(x, dy[rows], rcond=None)
        residual = dy[rows] - x @ beta
        ssr = float(residual @ residual)
        if rank < x.shape[1] or ssr <= 1e-12 * float(dy[rows] @ dy[rows]):
            return np.inf, len(rows), None
        spread = ssr / (len(rows) - x.shape[1]) * np.linalg.inv(x.T @ x)[0, 0]
        return len(rows) * np.log(ssr / len(rows)) + 2 * x.shape[1], len(rows), float(beta[0] / np.sqrt(spread))

    best = min(range(max_lag + 1), key=lambda lag: (fit(lag, max_lag)[0], lag))
    _, used, statistic = fit(best, best)
    return best, used, statistic


def stationarity_autolag(
    series: DataFrame, key_cols: list[str], t_col: str, y_col: str, max_lag: int | None = None
) -> DataFrame:
    """T4 with the whole lag search: the augmented Dickey-Fuller test with
    constant, its lagged differences chosen by AIC among 0..max_lag (by
    default ceil(12 (n / 100)^(1/4)), at most n / 2 - 2). Columns as
    ``stationarity``. Each key's series (bounded by its months) is one group."""
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in series.select(*key_cols).schema.fields)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        y = rows.sort_values("_t")["_y"].dropna().to_numpy(float)
        used, n_obs, statistic = _adf_search(y, max_lag)
        out = rows[key_cols].head(1).reset_index(drop=True)
        return out.assign(used_lag=used, n_obs=n_obs, adf_statistic=np.nan if statistic is None else statistic)

    rows = series.select(*key_cols, F.col(t_col).alias("_t"), F.col(y_col).cast("double").alias("_y"))
    found = rows.groupBy(*key_cols).applyInPandas(run, f"{keys}, used_lag int, n_obs long, adf_statistic double")
    return _judged(found.withColumn("adf_statistic", F.when(~F.isnan("adf_statistic"), F.col("adf_statistic"))), key_cols)


def stationarity(series: DataFrame, key_cols: list[str], t_col: str, y_col: str, max_lag: int = 1) -> DataFrame:
    """T4: augmented Dickey-Fuller test with constant, per key.

    Regress dy_t on [1, y_{t-1}] (lag 0) and on [1, y_{t-1}, dy_{t-1}]
    (lag 1). With ``max_lag=1`` both are fitted on the common sample (rows
    where dy_{t-1} exists) and the lower AIC picks the lag (ties: lag 0);
    the chosen regression is then refitted on its own full sample. The
    statistic is the t value of the y_{t-1} coefficient, ``p_value`` its
    approximate p-value, and ``is_stationary`` says whether that is under
    0.05 (``critical_5pct`` is the finite-sample critical value, for
    comparison). Two-regressor fits use centred covariance sums, so the whole
    test is one window pass and one aggregate per key; for more lags use
    ``stationarity_autolag``. Keys too short to test have NULLs and a reason.
    """
    if max_lag not in (0, 1):
        raise ValueError("max_lag must be 0 or 1; stationarity_autolag searches further")
    w = _w(key_cols, t_col)
    d = series.select(
        *key_cols,
        t_col,
        F.lag(y_col, 1).over(w).alias("x"),
        (F.col(y_col) - F.lag(y_col, 1).over(w)).alias("dy"),
    ).withColumn("dl", F.lag("dy", 1).over(w))
    common = F.col("dl").isNotNull()

    def c(e):  # restrict an aggregate's input to the common sample
        return F.when(common, e)

    s = d.groupBy(*key_cols).agg(
        # lag 0 on its full sample
        F.regr_count("dy", "x").alias("n0"),
        F.regr_slope("dy", "x").alias("b0"),
        F.regr_sxx("dy", "x").alias("sxx0"),
        F.regr_sxy("dy", "x").alias("sxy0"),
        F.regr_syy("dy", "x").alias("syy0"),
        # both lags on the common sample (centred sums = n * population moments)
        F.count(c(F.col("dy") + F.col("x") + F.col("dl"))).alias("nc"),
        F.var_pop(c(F.col("x"))).alias("v11"),
        F.var_pop(c(F.col("dl"))).alias("v22"),
        F.covar_pop(c(F.col("x")), c(F.col("dl"))).alias("v12"),
        F.covar_pop(c(F.col("x")), c(F.col("dy"))).alias("v1y"),
        F.covar_pop(c(F.col("dl")), c(F.col("dy"))).alias("v2y"),
        F.var_pop(c(F.col("dy"))).alias("vyy"),
    )
    n0, nc = F.col("n0").cast("double"), F.col("nc").cast("double")
    # lag 0, full sample
    ssr0 = F.col("syy0") - F.try_divide(F.col("sxy0") * F.col("sxy0"), F.col("sxx0"))
    t0 = F.try_divide(F.col("b0"), F.sqrt(F.try_divide(F.try_divide(ssr0, n0 - 2), F.col("sxx0"))))
    # common sample: lag 0 and lag 1 residual sums of squares
    det = F.col("v11") * F.col("v22") - F.col("v12") * F.col("v12")
    b1 = F.try_divide(F.col("v22") * F.col("v1y") - F.col("v12") * F.col("v2y"), det)
    b2 = F.try_divide(F.col("v11") * F.col("v2y") - F.col("v12") * F.col("v1y"), det)
    ssr1 = nc * (F.col("vyy") - b1 * F.col("v1y") - b2 * F.col("v2y"))
    ssr0c = nc * (F.col("vyy") - F.try_divide(F.col("v1y") * F.col("v1y"), F.col("v11")))
    aic0 = F.when(ssr0c > 0, nc * F.log(F.try_divide(ssr0c, nc)) + F.lit(4.0))
    aic1 = F.when(ssr1 > 0, nc * F.log(F.try_divide(ssr1, nc)) + F.lit(6.0))
    t1 = F.try_divide(b1, F.sqrt(F.try_divide(F.try_divide(ssr1, nc - 3) * F.col("v22"), nc * det)))
    use1 = F.lit(max_lag == 1) & (F.col("nc") >= 4) & aic1.isNotNull() & aic0.isNotNull() & (aic1 < aic0)
    chosen = s.select(
        *key_cols,
        F.when(use1, 1).otherwise(0).alias("used_lag"),
        F.when(use1, F.col("nc")).otherwise(F.col("n0")).alias("n_obs"),
        F.when(use1, t1).otherwise(t0).alias("adf_statistic"),
    )
    return _judged(chosen, key_cols)


def _seasonal_steps(series: DataFrame, key_cols: list[str], t_col: str, y_col: str, month_col: str, periods: int, value_col: str) -> DataFrame:
    """``(keys, month, t, <value_col>)`` for the keys that are long enough."""
    if int(periods) < 1:
        raise ValueError("periods must be 1 or more")
    w = _w(key_cols, t_col)
    w_all = Window.partitionBy(*key_cols)
    last_row = _w(key_cols, t_col).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    u = series.withColumn("_u", F.col(y_col) - F.lag(y_col, SEASON).over(w))
    uw = u.withColumn("_w", F.col("_u") - F.lag("_u", 1).over(w))
    lagged = uw.withColumn("_wl", F.lag("_w", 1).over(w))
    stats = (
        lagged.withColumn("_n", F.count(F.lit(1)).over(w_all))
        .withColumn("_num", F.sum(F.col("_w") * F.col("_wl")).over(w_all))
        .withColumn("_den", F.sum(F.col("_wl") * F.col("_wl")).over(w_all))
        .withColumn("_T", F.max(t_col).over(w_all))
        .withColumn("_uT", F.last("_u").over(last_row))
        .withColumn("_wT", F.last("_w").over(last_row))
        .withColumn("_lastm", F.max(month_col).over(w_all))
    )
    phi = F.coalesce(F.try_divide(F.col("_num"), F.col("_den")), F.lit(0.0))
    first = (F.col(t_col) - F.col("_T") + F.lit(SEASON)).cast("int")
    # u_{T+s} = u_T + w_T (phi + ... + phi^s); beyond a season the value a season
    # before is itself a forecast, so the seasonal differences add up.
    value = F.col(y_col) + F.aggregate(
        F.sequence(F.col("_first"), F.col("_h"), F.lit(SEASON)),
        F.lit(0.0),
        lambda acc, s: acc
        + F.col("_uT")
        + F.col("_wT") * F.aggregate(F.sequence(F.lit(1), s), F.lit(0.0), lambda b, i: b + F.pow(F.col("_phi"), i)),
    )
    return (
        stats.filter(F.col("_n") >= MIN_SEASONAL_POINTS)
        .withColumn("_first", first)
        .filter((F.col("_first") >= 1) & (F.col("_first") <= int(periods)))
        .withColumn("_phi", phi)
        .withColumn("_h", F.explode(F.sequence(F.col("_first"), F.lit(int(periods)), F.lit(SEASON))))
        .select(
            *key_cols,
            F.add_months(F.col("_lastm").cast("date"), F.col("_h")).cast("timestamp_ntz").alias("month"),
            (F.col("_T") + F.col("_h")).cast("int").alias("t"),
            value.alias(value_col),
        )
    )


def seasonal_forecast(
    series: DataFrame,
    key_cols: list[str],
    t_col: str,
    y_col: str,
    month_col: str = "timestamp_month",
    periods: int = 3,
    value_col: str = "forecast",
) -> DataFrame:
    """T5: SARIMA(1,1,0)(0,1,0)_12 by conditional least squares, per key.

    u_t = y_t - y_{t-12}, w_t = u_t - u_{t-1}, phi = sum w_t w_{t-1} / sum w_{t-1}^2;
    forecast y_{T+h} = y_{T+h-12} + u_T + w_T * sum_{i=1..h} phi^i, where a
    y beyond T is its own forecast. The row at T-12+r carries the forecasts
    of the steps r, r + 12, ..., so the plan is windows on one partitioning.
    Output ``(keys, month, t, <value_col>, reason)``; a key with fewer than
    15 points has one row with NULLs and the reason.
    """
    found = _seasonal_steps(series, key_cols, t_col, y_col, month_col, periods, value_col)
    short = series.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") < MIN_SEASONAL_POINTS)
    short = short.select(
        *key_cols,
        *[F.lit(None).cast(t).alias(c) for c, t in found.dtypes if c not in key_cols],
        F.lit(f"fewer than {MIN_SEASONAL_POINTS} points").alias("reason"),
    )
    return found.withColumn("reason", F.lit(None).cast("string")).unionByName(short)


def forecast_evaluation(
    series: DataFrame,
    key_cols: list[str],
    t_col: str,
    y_col: str,
    month_col: str = "timestamp_month",
    periods: int = 3,
    align: str = "holdout",
) -> DataFrame:
    """MAE, MSE, RMSE of the seasonal forecast, per key.

    ``align="holdout"`` (default): fit without the last ``periods`` points and
    score the forecast against them. ``align="reference"``: fit on all points
    and compare forecasts for T+1..T+n with the observations T-n+1..T, by
    position, as the reference does."""
    if align not in ("holdout", "reference"):
        raise ValueError("align must be 'holdout' or 'reference'")
    n = int(periods)
    w_all = Window.partitionBy(*key_cols)
    marked = series.withColumn("_T", F.max(t_col).over(w_all))
    if align == "holdout":
        fit = marked.filter(F.col(t_col) <= F.col("_T") - n).drop("_T")
        fc = _seasonal_steps(fit, key_cols, t_col, y_col, month_col, n, "fc")
        obs = series.select(*key_cols, F.col(t_col).cast("int").alias("t"), F.col(y_col).alias("obs"))
        pairs = fc.join(obs, on=[*key_cols, "t"], how="inner")
    else:
        fc = _seasonal_steps(series, key_cols, t_col, y_col, month_col, n, "fc")
        obs = marked.filter(F.col(t_col) > F.col("_T") - n).select(
            *key_cols, (F.col(t_col) + F.lit(n)).cast("int").alias("t"), F.col(y_col).alias("obs")
        )
        pairs = fc.join(obs, on=[*key_cols, "t"], how="inner")
    e = F.col("fc") - F.col("obs")
    return pairs.groupBy(*key_cols).agg(
        F.count(F.lit(1)).alias("n_compared"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
    )
