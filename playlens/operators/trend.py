"""Trend models on keyed series (M1-M5, M8-M13), fitted for all keys at once.

A series frame has key columns, an integer time index ``t_col`` (the month
counter), a DOUBLE target ``y_col`` and the month start ``month_col``.

With one feature, least squares, ridge and lasso are closed forms of a few
per-group sums (``regr_sxx``, ``regr_sxy``, means, ``sum(x*x)``,
``sum(x*y)``), so fitting, cross-validation and grid search are grouped
aggregates and equi-joins on the key: thousands of series cost one job, and
no series is ever collected to the driver.

Closed forms (x = feature, y = target, n rows, Sxx/Sxy centred sums):

* least squares with intercept:   w = Sxy / Sxx,              b = ybar - w*xbar
* least squares through 0:        w = sum(xy) / sum(x^2),     b = 0
* ridge (intercept not penalised): w = Sxy / (Sxx + alpha)
  (through 0: sum(xy) / (sum(x^2) + alpha))
* lasso, objective RSS/(2n) + alpha*|w|:
  w = sign(Sxy) * max(|Sxy| - n*alpha, 0) / Sxx
A zero denominator gives w = 0 (the minimum-norm solution).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions.stats import significant

# --- Fixed values: the hyper-parameter grids of the linear family, in the
# --- reference's grid order (ties between equal scores go to the first).
# (model, grid position, best_params text, fit_intercept, alpha)
LINEAR_GRID = [
    ("LinearRegression", 0, '{"copy_X": true, "fit_intercept": true}', True, None),
    ("LinearRegression", 1, '{"copy_X": true, "fit_intercept": false}', False, None),
    ("Ridge", 0, '{"alpha": 0.1}', True, 0.1),
    ("Ridge", 1, '{"alpha": 1.0}', True, 1.0),
    ("Ridge", 2, '{"alpha": 10.0}', True, 10.0),
    ("Ridge", 3, '{"alpha": 100.0}', True, 100.0),
    ("Lasso", 0, '{"alpha": 0.001}', True, 0.001),
    ("Lasso", 1, '{"alpha": 0.01}', True, 0.01),
    ("Lasso", 2, '{"alpha": 0.1}', True, 0.1),
    ("Lasso", 3, '{"alpha": 1.0}', True, 1.0),
]
LINEAR_MODELS = ("LinearRegression", "Ridge", "Lasso")
DEFAULT_TRAIN_RATIO = 0.67
DEFAULT_FOLDS = 3
RIDGE_DEFAULT_ALPHA = 1.0


def _sql_value(v) -> str:
    if v is None:
        return "CAST(NULL AS DOUBLE)"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else str(int(v))


def _settings_array(grid=LINEAR_GRID) -> Column:
    """The grid as one array-of-structs literal (a single expression, so the
    plan is built with one JVM call instead of one per field)."""
    structs = [
        "named_struct('model', {}, 'grid_pos', {}, 'params', {}, 'fit_intercept', {}, 'alpha', {})".format(
            _sql_value(m), _sql_value(pos), _sql_value(params), _sql_value(fi), _sql_value(alpha)
        )
        for m, pos, params, fi, alpha in grid
    ]
    return F.expr("array(" + ", ".join(structs) + ")")


def fit_sums(df: DataFrame, group_cols: list[str], x: str, y: str) -> DataFrame:
    """The sufficient statistics of a one-feature fit, per group."""
    xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
    return df.groupBy(*group_cols).agg(
        F.regr_count(yc, xc).alias("n"),
        F.regr_sxx(yc, xc).alias("sxx"),
        F.regr_sxy(yc, xc).alias("sxy"),
        F.regr_avgx(yc, xc).alias("avgx"),
        F.regr_avgy(yc, xc).alias("avgy"),
        F.sum(F.when(yc.isNotNull(), xc * xc)).alias("sum_xx"),  # the rows the other sums use
        F.sum(xc * yc).alias("sum_xy"),
    )


def _safe_div(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) = 0 THEN 0.0D ELSE try_divide({num}, {den}) END"


def coefficients(
    sums: DataFrame, model: str = "model", fit_intercept: str = "fit_intercept", alpha: str = "alpha"
) -> DataFrame:
    """Add ``slope`` and ``intercept`` for each row of ``sums`` (closed forms).

    ``model``, ``fit_intercept`` and ``alpha`` are SQL expressions over
    ``sums`` - column names, or literals such as ``"'Ridge'"``.
    """
    a = f"coalesce({alpha}, 0.0D)"
    ridge = f"CASE WHEN {model} = 'Ridge' THEN {a} ELSE 0.0D END"
    slope = (
        f"CASE WHEN {model} = 'Lasso' THEN "
        + _safe_div(f"signum(sxy) * greatest(abs(sxy) - n * {a}, 0.0D)", "sxx")
        + f" WHEN {fit_intercept} THEN "
        + _safe_div("sxy", f"sxx + {ridge}")
        + " ELSE "
        + _safe_div("sum_xy", f"sum_xx + {ridge}")
        + " END"
    )
    intercept = f"CASE WHEN {fit_intercept} OR {model} = 'Lasso' THEN avgy - slope * avgx ELSE 0.0D END"
    return sums.withColumn("slope", F.expr(slope)).withColumn("intercept", F.expr(intercept))


# ---------------------------------------------------------------------------
# M1, M2: split and folds
# ---------------------------------------------------------------------------


def train_test_split(
    series: DataFrame, key_cols: list[str], t_col: str = "count_months", train_ratio: float = DEFAULT_TRAIN_RATIO
) -> DataFrame:
    """M1: per key, the first ``int(ratio * n)`` rows by time are ``train``,
    the rest ``test`` (no shuffling of rows). Adds ``split``."""
    w_all = Window.partitionBy(*key_cols)
    w_ord = Window.partitionBy(*key_cols).orderBy(F.col(t_col).asc())
    n_train = F.floor(F.lit(float(train_ratio)) * F.count(F.lit(1)).over(w_all))
    return series.withColumn(
        "split", F.when((F.row_number().over(w_ord) - 1) < n_train, F.lit("train")).otherwise(F.lit("test"))
    )


def kfold(
    train: DataFrame, key_cols: list[str], t_col: str = "count_months", n_folds: int = DEFAULT_FOLDS
) -> DataFrame:
    """M2: contiguous, unshuffled folds over each key's train rows (``fold``
    0..k-1; the first ``n % k`` folds get one extra row)."""
    w = Window.partitionBy(*key_cols).orderBy(F.col(t_col).asc())
    return train.withColumn("fold", (F.ntile(int(n_folds)).over(w) - 1).cast("int"))


# ---------------------------------------------------------------------------
# M3-M5: single fits
# ---------------------------------------------------------------------------


def _fit_grid(train: DataFrame, key_cols: list[str], x: str, y: str, models: tuple[str, ...]) -> DataFrame:
    sums = fit_sums(train, key_cols, x, y)
    grid = [g for g in LINEAR_GRID if g[0] in models]
    exploded = sums.withColumn("s", F.explode(_settings_array(grid))).select("*", "s.*").drop("s")
    return coefficients(exploded)


def _coef_out(df: DataFrame, key_cols: list[str], extra: list[str]) -> DataFrame:
    return df.select(
        *key_cols,
        *extra,
        "slope",
        "intercept",
        F.col("n").cast("long").alias("n_train"),
    )


def fit_linear_regression(train: DataFrame, key_cols: list[str], x: str, y: str) -> DataFrame:
    """M3: least squares with and without intercept, per key."""
    return _coef_out(_fit_grid(train, key_cols, x, y, ("LinearRegression",)), key_cols, ["fit_intercept"])


def fit_ridge(train: DataFrame, key_cols: list[str], x: str, y: str) -> DataFrame:
    """M4: ridge for every alpha of the grid, per key."""
    return _coef_out(_fit_grid(train, key_cols, x, y, ("Ridge",)), key_cols, ["alpha"])


def fit_lasso(train: DataFrame, key_cols: list[str], x: str, y: str) -> DataFrame:
    """M5: lasso for every alpha of the grid, per key."""
    return _coef_out(_fit_grid(train, key_cols, x, y, ("Lasso",)), key_cols, ["alpha"])


# ---------------------------------------------------------------------------
# Grid search, held-out metrics, leaderboard - one scoring pass
# ---------------------------------------------------------------------------

_FULL_FIT = -1  # fold id of the model fitted on all train rows
_K, _M = "__pl_fold", "__pl_rows"

#: Column names of the scores, which a key column can't have.
_TAKEN = {
    "model", "grid_pos", "params", "best_params", "fit_intercept", "alpha", "slope", "intercept", "n", "fold", "s",
    "sxx", "sxy", "avgx", "avgy", "sum_xx", "sum_xy", "cv_mse", "n_test", "mse", "sse", "sst", "rmse", "r2", "rank", "reason",
}


def _check_keys(key_cols: list[str]) -> None:
    if taken := sorted(_TAKEN.intersection(key_cols)):
        raise ValueError(f"rename the key columns {taken}: the scores have columns of that name")


def model_scores(
    series: DataFrame,
    key_cols: list[str],
    x: str = "count_months",
    y: str = "y",
    train_ratio: float = DEFAULT_TRAIN_RATIO,
    n_folds: int = DEFAULT_FOLDS,
) -> DataFrame:
    """Every linear setting of every key, fitted and scored in one pass.

    * Fits: each train row is emitted once for every fold it is *not* in
      (the cross-validation fits) and once more for the fit on all train rows
      (fold id -1) - an ``explode`` of a k-element array, no self join. The
      fit sums are aggregated per (key, fold) directly (no subtraction of
      sums, so no cancellation) and expanded to the 10 grid settings.
    * Scores: train rows meet the model of their own fold, test rows the
      full-train model, in a single equi-join on (key, fold); squared errors
      aggregate per (key, fold, setting).

    Output per (key, setting): ``cv_mse`` (mean of the per-fold MSEs), the
    full-train ``slope``/``intercept``, and the test-tail ``n_test``,
    ``mse``, ``sse``, ``sst``. Keys that can't be scored (fewer train rows
    than folds, no test rows) are not here; the functions built on the scores
    return them with NULLs and a ``reason``. Rows with a NULL target count in
    the split and take no part in fits and scores.
    """
    _check_keys(key_cols)
    # One window pass: position and train size per key; the fold of a train
    # row follows ``kfold`` (ntile: the first n_train % k folds get one extra
    # row), test rows get the full-train fold id. No union, so the rows stay
    # partitioned by key.
    k = int(n_folds)
    w_all = Window.partitionBy(*key_cols)
    w_ord = Window.partitionBy(*key_cols).orderBy(F.col(x).asc())
    pos = (F.row_number().over(w_ord) - 1).alias("_pos")
    n_train = F.floor(F.lit(float(train_ratio)) * F.count(F.lit(1)).over(w_all)).alias("_nt")
    fold = F.expr(
        f"CASE WHEN _pos >= _nt THEN {_FULL_FIT} "
        f"WHEN _pos < (_nt % {k}) * (_nt div {k} + 1) THEN _pos div (_nt div {k} + 1) "
        f"ELSE (_nt % {k}) + (_pos - (_nt % {k}) * (_nt div {k} + 1)) div (_nt div {k}) END"
    ).cast("int")
    rows = (
        series.select(*key_cols, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), pos, n_train)
        .filter(F.col("_nt") >= k)
        .select(*key_cols, "_x", "_y", fold.alias("fold"))
    )

    fit_ids = F.array(*[F.lit(i) for i in [*range(k), _FULL_FIT]])
    fit_rows = rows.filter(F.col("fold") != _FULL_FIT).withColumn(
        _K, F.explode(F.filter(fit_ids, lambda i: i != F.col("fold")))
    )
    models = coefficients(
        fit_sums(fit_rows, [*key_cols, _K], "_x", "_y")
        .withColumn("s", F.explode(_settings_array()))
        .select("*", "s.*")
        .drop("s")
    ).select(*key_cols, _K, "model", "grid_pos", "params", "fit_intercept", "alpha", "slope", "intercept", "n")

    err = F.col("_y") - (F.col("intercept") + F.col("slope") * F.col("_x"))
    per_fold = (
        rows.withColumnRenamed("fold", _K)
        .join(models, on=[*key_cols, _K], how="inner")
        .withColumn("_e", err)
        .groupBy(*key_cols, _K, "model", "grid_pos")
        .agg(
            F.count("_e").alias(_M),
            F.avg(F.col("_e") * F.col("_e")).alias("mse"),
            F.sum(F.col("_e") * F.col("_e")).alias("sse"),
            (F.var_pop(F.when(F.col("_e").isNotNull(), F.col("_y"))) * F.count("_e")).alias("sst"),
            F.first("params").alias("params"),
            F.first("fit_intercept").alias("fit_intercept"),
            F.first("alpha").alias("alpha"),
            F.first("slope").alias("slope"),
            F.first("intercept").alias("intercept"),
            F.first("n").alias("n"),
        )
    )
    # One reader of ``models``: the full-train coefficients (fold -1) ride
    # along with the test-tail scores.
    cv, full = F.col(_K) != _FULL_FIT, F.col(_K) == _FULL_FIT
    return (
        per_fold.groupBy(*key_cols, "model", "grid_pos")
        .agg(
            F.first("params").alias("params"),
            F.first("fit_intercept").alias("fit_intercept"),
            F.first("alpha").alias("alpha"),
            F.avg(F.when(cv, F.col("mse"))).alias("cv_mse"),
            F.max(F.when(full, F.col(_M))).alias("n_test"),
            F.max(F.when(full, F.col("mse"))).alias("mse"),
            F.max(F.when(full, F.col("sse"))).alias("sse"),
            F.max(F.when(full, F.col("sst"))).alias("sst"),
            F.max(F.when(full, F.col("slope"))).alias("slope"),
            F.max(F.when(full, F.col("intercept"))).alias("intercept"),
            F.max(F.when(full, F.col("n"))).alias("n"),
        )
        .filter(F.col("cv_mse").isNotNull() & F.col("slope").isNotNull())
    )


def _winners(scores: DataFrame, key_cols: list[str]) -> DataFrame:
    """Per (key, model): the setting with the lowest CV MSE, compared by
    significant digits, so that the winner does not depend on the unit of the
    target (ties: grid order)."""
    w_best = Window.partitionBy(*key_cols, "model").orderBy(
        significant(F.col("cv_mse")).asc(), F.col("grid_pos").asc()
    )
    return scores.withColumn("_r", F.row_number().over(w_best)).filter(F.col("_r") == 1).drop("_r")


def _with_unscored(found: DataFrame, series: DataFrame, key_cols: list[str], train_ratio: float, n_folds: int) -> DataFrame:
    """``found`` with a NULL ``reason``, and one row for each key it lacks,
    with NULL scores and the reason."""
    n_train = F.floor(F.lit(float(train_ratio)) * F.col("__pl_n"))
    keys = series.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("__pl_n")).withColumn("__pl_train", n_train)
    reason = (
        F.when(F.col("__pl_train") < int(n_folds), F.lit("fewer train rows than folds"))
        .when(F.col("__pl_train") >= F.col("__pl_n"), F.lit("no test rows"))
        .otherwise(F.lit("no rows with a target to fit or to score"))
    )
    # One left join from the keys: ``found``, the whole search, is evaluated once.
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in key_cols]
    joined = keys.alias("a").join(found.withColumn("__pl_hit", F.lit(True)).alias("b"), on=same, how="left")
    return joined.select(
        *[F.col(f"a.{c}") for c in key_cols],
        *[F.col(f"b.{c}") for c in found.columns if c not in key_cols],
        F.when(F.col("__pl_hit").isNull(), reason).alias("reason"),
    )


def grid_search(
    series: DataFrame,
    key_cols: list[str],
    x: str = "count_months",
    y: str = "y",
    train_ratio: float = DEFAULT_TRAIN_RATIO,
    n_folds: int = DEFAULT_FOLDS,
    all_settings: bool = False,
) -> DataFrame:
    """M8: for every key and every linear model, the grid setting with the
    lowest mean validation MSE over ``n_folds`` contiguous folds of the train
    rows (ties: first in grid order). Output ``(keys, model, grid_pos,
    best_params, cv_mse, reason)``; ``all_settings=True`` keeps every setting."""
    scores = model_scores(series, key_cols, x, y, train_ratio, n_folds)
    if not all_settings:
        scores = _winners(scores, key_cols)
    found = scores.select(*key_cols, "model", "grid_pos", F.col("params").alias("best_params"), "cv_mse")
    return _with_unscored(found, series, key_cols, train_ratio, n_folds)


def _r2(n: Column, sse: Column, sst: Column) -> Column:
    return (
        F.when(n < 2, F.lit(None).cast("double"))
        .when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(F.lit(1.0) - F.try_divide(sse, sst))
    )


def _winner_metrics(series, key_cols, x, y, train_ratio, n_folds) -> DataFrame:
    w = _winners(model_scores(series, key_cols, x, y, train_ratio, n_folds), key_cols)
    return w.withColumn("rmse", F.sqrt(F.col("mse"))).withColumn(
        "r2", _r2(F.col("n_test"), F.col("sse"), F.col("sst"))
    )


def test_metrics(
    series: DataFrame,
    key_cols: list[str],
    x: str = "count_months",
    y: str = "y",
    train_ratio: float = DEFAULT_TRAIN_RATIO,
    n_folds: int = DEFAULT_FOLDS,
) -> DataFrame:
    """M9: each model's grid winner, refitted on all train rows, scored on
    the held-out tail: ``mse``, ``rmse``, ``r2`` (1 - SSE/SST; SST = 0 gives
    1 when SSE = 0 else 0; fewer than 2 test rows give NULL)."""
    m = _winner_metrics(series, key_cols, x, y, train_ratio, n_folds)
    found = m.select(*key_cols, "model", F.col("params").alias("best_params"), "mse", "rmse", "r2")
    return _with_unscored(found, series, key_cols, train_ratio, n_folds)


def _ranked(series, key_cols, x, y, train_ratio, n_folds) -> DataFrame:
    m = _winner_metrics(series, key_cols, x, y, train_ratio, n_folds)
    w = Window.partitionBy(*key_cols).orderBy(
        significant(F.col("rmse")).asc_nulls_last(), F.col("model").asc()
    )
    return m.withColumn("rank", F.row_number().over(w).cast("int"))


def leaderboard(
    series: DataFrame,
    key_cols: list[str],
    x: str = "count_months",
    y: str = "y",
    train_ratio: float = DEFAULT_TRAIN_RATIO,
    n_folds: int = DEFAULT_FOLDS,
) -> DataFrame:
    """Per key, one row per model ``(model, best_params, rmse, r2)`` with
    ``rank`` 1 = lowest test RMSE (ties: model name)."""
    found = _ranked(series, key_cols, x, y, train_ratio, n_folds).select(
        *key_cols, "model", F.col("params").alias("best_params"), "rmse", "r2", "rank"
    )
    return _with_unscored(found, series, key_cols, train_ratio, n_folds)


def refit(
    series: DataFrame,
    settings: DataFrame,
    key_cols: list[str],
    x: str = "count_months",
    y: str = "y",
    train_ratio: float = DEFAULT_TRAIN_RATIO,
    fit_on: str = "train",
) -> DataFrame:
    """Refit each (key, setting) row of ``settings`` (columns model,
    fit_intercept, alpha, ...) on the key's train rows (``fit_on="train"``,
    as the reference does) or on all rows (``"all"``)."""
    if fit_on not in ("train", "all"):
        raise ValueError("fit_on must be 'train' or 'all'")
    rows = train_test_split(series, key_cols, x, train_ratio)
    if fit_on == "train":
        rows = rows.filter(F.col("split") == "train")
    sums = fit_sums(rows, key_cols, x, y)
    joined = settings.drop("slope", "intercept", "n").join(sums, on=key_cols, how="inner")
    return coefficients(joined)


# ---------------------------------------------------------------------------
# forecasts
# ---------------------------------------------------------------------------


def forecast_future_periods(
    series: DataFrame,
    coefs: DataFrame,
    key_cols: list[str],
    x: str = "count_months",
    n_periods: int = 3,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``t = last + 1 .. last + n`` per key and ``intercept + slope * t``.

    ``coefs`` holds one (slope, intercept) per key. Output
    ``(keys, t, forecast)``; the last index and last month per key ride along
    as ``last_t`` / ``last_month`` for M12.
    """
    if int(n_periods) < 1:
        raise ValueError("n_periods must be 1 or more")
    last = series.groupBy(*key_cols).agg(
        F.max(F.col(x)).alias("last_t"), F.max(F.col("timestamp_month")).alias("last_month")
    )
    return (
        last.join(coefs.select(*key_cols, "slope", "intercept", *carry), on=key_cols, how="inner")
        .withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(int(n_periods)))))
        .withColumn("t", (F.col("last_t") + F.col("h")).cast("int"))
        .withColumn("forecast", F.col("intercept") + F.col("slope") * F.col("t"))
    )


def create_forecast_calendar(
    forecast: DataFrame, key_cols: list[str], value_col: str, extra: tuple[str, ...] = ()
) -> DataFrame:
    """Label each step with the month start ``h`` months after the last
    observed month. Output ``(keys, month, t, <value_col>, *extra)``."""
    month = F.add_months(F.col("last_month").cast("date"), F.col("h")).cast("timestamp_ntz")
    return forecast.select(
        *key_cols, month.alias("month"), "t", F.col("forecast").alias(value_col), *extra
    )


def best_settings(
    series: DataFrame,
    key_cols: list[str],
    x: str = "count_months",
    y: str = "y",
    family: str = "best",
    train_ratio: float = DEFAULT_TRAIN_RATIO,
) -> DataFrame:
    """The setting to forecast with, per key, with its train-fit coefficients.

    ``family="best"``: the leaderboard's first model with its own settings.
    ``family="ridge"``: the reference's behaviour - a Ridge built from the
    winner's parameters (alpha if it has one, else 1.0; its fit_intercept if
    it has one, else True); its coefficients are then refitted.
    """
    if family not in ("best", "ridge"):
        raise ValueError("family must be 'best' or 'ridge'")
    chosen = _ranked(series, key_cols, x, y, train_ratio, DEFAULT_FOLDS).filter(F.col("rank") == 1)
    chosen = chosen.select(*key_cols, "model", "grid_pos", "params", "fit_intercept", "alpha", "slope", "intercept")
    if family == "ridge":
        chosen = (
            chosen.withColumn("alpha", F.coalesce(F.col("alpha"), F.lit(RIDGE_DEFAULT_ALPHA)))
            .withColumn(
                "fit_intercept", F.when(F.col("model") == "LinearRegression", F.col("fit_intercept")).otherwise(True)
            )
            .withColumn("model", F.lit("Ridge"))
        )
        chosen = refit(series, chosen, key_cols, x, y, train_ratio)
    return chosen


def best_model_forecast(
    series: DataFrame,
    key_cols: list[str],
    x: str = "count_months",
    y: str = "y",
    n_periods: int = 3,
    family: str = "best",
    fit_on: str = "train",
    value_col: str = "forecast",
    unit_factor: float | None = None,
    unit_col: str | None = None,
) -> DataFrame:
    """Leaderboard -> best setting -> (refit) -> forecast with month
    labels. With the defaults the leaderboard's own train-fit coefficients
    are used, so the grid is searched once. ``unit_factor`` adds the
    forecast in a second unit (``value * factor``). A key that can't be scored
    has one row of NULLs with its ``reason``."""
    chosen = best_settings(series, key_cols, x, y, family)
    if fit_on != "train":
        chosen = refit(series, chosen, key_cols, x, y, fit_on=fit_on)
    coefs = chosen.select(*key_cols, "model", "slope", "intercept")
    fc = forecast_future_periods(series, coefs, key_cols, x, n_periods, carry=("model",))
    extra: list = ["model"]
    if unit_factor is not None and unit_col:
        fc = fc.withColumn(unit_col, F.col("forecast") * F.lit(float(unit_factor)))
        extra.append(unit_col)
    found = create_forecast_calendar(fc, key_cols, value_col, tuple(extra))
    return _with_unscored(found, series, key_cols, DEFAULT_TRAIN_RATIO, DEFAULT_FOLDS)
