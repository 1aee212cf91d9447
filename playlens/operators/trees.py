"""Tree ensembles per series (M6 random forest, M7 gradient boosting).

A series has one feature, its time index, so a regression tree is a step
function of it: sorted bounds and one value between each two of them. A sum of
trees is a step function again. So an ensemble of any size is two arrays in a
column, and predicting, scoring and forecasting with it are Spark expressions,
for all keys at once.

Every key is searched and fitted by itself in one task (a series is bounded by
its months; the keys are what grows, and Spark deals them out). Work is shared
where settings can't differ: the trees of a smaller forest or of fewer boosting
rounds are the first ones of the larger, and a limit on depth or node size only
ends a tree sooner, so each bootstrap sample is grown once for all settings.

Split: the place between two different feature values that leaves the least
squared error, first one among equals; bound: the middle between the two.
Forests draw n of n rows with replacement for each tree. Boosting starts at the
mean and adds ``learning_rate`` times a tree of the residuals. Validation is on
the contiguous folds of M2, the held-out tail is that of M1; rows without a
target count in the split and take no part in fits and scores.
"""

from __future__ import annotations

import itertools
import json
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from playlens.functions.stats import significant
from playlens.operators.trend import (
    DEFAULT_FOLDS,
    DEFAULT_TRAIN_RATIO,
    _check_keys,
    _r2,
    _ranked,
    _with_unscored,
    create_forecast_calendar,
    test_metrics,
)

SEED = 42
RANK_FORMAT = "%.9e"  # ten significant digits, as in the linear family

# --- Fixed values: the reference's tree grids.
# random forest: n_estimators x max_depth x min_samples_split
RF_GRID = {"n_estimators": [100, 200], "max_depth": [None, 5, 10], "min_samples_split": [2, 5]}
# gradient boosting: n_estimators x learning_rate x max_depth
GBT_GRID = {"n_estimators": [100, 200], "learning_rate": [0.05, 0.1], "max_depth": [2, 3]}

KINDS = {"random_forest": ("RandomForestRegressor", RF_GRID), "gbt": ("GradientBoostingRegressor", GBT_GRID)}

#: (bounds, values): the value at x is ``values[number of bounds below x]``.
Step = tuple[np.ndarray, np.ndarray]


def settings(kind: str, full_grid: bool = True) -> list[dict]:
    """The grid in order; its first setting alone without ``full_grid``."""
    if kind not in KINDS:
        raise ValueError("kind must be 'random_forest' or 'gbt'")
    grid = KINDS[kind][1]
    combos = [dict(zip(grid, c)) for c in itertools.product(*grid.values())]
    return combos if full_grid else combos[:1]


# -- step functions ---------------------------------------------------------
def evaluate(step: Step, x: np.ndarray) -> np.ndarray:
    return step[1][np.searchsorted(step[0], x, side="left")]


def add_up(steps: list[Step], weight: float, start: float = 0.0) -> Step:
    """``start`` plus ``weight`` times the sum of step functions."""
    bounds = np.unique(np.concatenate([s[0] for s in steps])) if steps else np.empty(0)
    places = np.append(bounds, np.inf)
    total = np.zeros(len(places))
    for s in steps:
        total += evaluate(s, places)
    return bounds, start + weight * total


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, limits: list[tuple[float, int]]) -> list[Step]:
    """One regression tree on rows sorted by ``x`` with weights, as it is under
    each (greatest depth, least rows of a node that is split)."""
    weight, total = np.concatenate([[0.0], np.cumsum(w)]), np.concatenate([[0.0], np.cumsum(w * y)])
    bounds: list[list[float]] = [[] for _ in limits]
    values: list[list[float]] = [[] for _ in limits]

    def walk(i: int, j: int, depth: int, growing: list[int], right: float) -> None:
        on = [s for s in growing if depth < limits[s][0] and j - i >= limits[s][1]]
        place = _best_split(x, y, weight, total, i, j) if on else 0
        if not place:
            on = []
        for s in growing:
            if s not in on:
                values[s].append((total[j] - total[i]) / (weight[j] - weight[i]))
                bounds[s].append(right)
        if on:
            middle = (x[place - 1] + x[place]) / 2
            walk(i, place, depth + 1, on, middle)
            walk(place, j, depth + 1, on, right)

    walk(0, len(x), 0, list(range(len(limits))), math.inf)
    return [(np.array(b[:-1]), np.array(v)) for b, v in zip(bounds, values)]


def _best_split(x: np.ndarray, y: np.ndarray, weight: np.ndarray, total: np.ndarray, i: int, j: int) -> int:
    """The first row of the right part, 0 if there is nothing to split."""
    if j - i < 2 or (y[i:j] == y[i]).all():
        return 0
    left_w, left = weight[i + 1 : j] - weight[i], total[i + 1 : j] - total[i]
    right_w, right = weight[j] - weight[i + 1 : j], total[j] - total[i + 1 : j]
    gain = np.where(x[i + 1 : j] > x[i : j - 1], left * left / left_w + right * right / right_w, -np.inf)
    best = int(gain.argmax())
    return i + 1 + best if gain[best] > -np.inf else 0


# -- ensembles --------------------------------------------------------------
def forests(x: np.ndarray, y: np.ndarray, combos: list[dict], seed: int = SEED) -> list[list[Step]]:
    """The trees of every setting of a forest; bootstrap samples are shared."""
    limits = sorted({_limit(c) for c in combos})
    rng = np.random.RandomState(seed)
    trees: list[list[Step]] = []
    for _ in range(max(c["n_estimators"] for c in combos)):
        drawn = np.bincount(rng.randint(0, len(x), len(x)), minlength=len(x))
        used = drawn > 0
        trees.append(grow(x[used], y[used], drawn[used].astype(float), limits))
    return [[t[limits.index(_limit(c))] for t in trees[: c["n_estimators"]]] for c in combos]


def _limit(combo: dict) -> tuple[float, int]:
    return (math.inf if combo["max_depth"] is None else combo["max_depth"], combo.get("min_samples_split", 2))


def boosted(x: np.ndarray, y: np.ndarray, combos: list[dict]) -> list[list[Step]]:
    """The trees of every setting of boosting; fewer rounds are the first of more."""
    found: dict[tuple, list[Step]] = {}
    for shape in {(c["learning_rate"], c["max_depth"]) for c in combos}:
        rate, depth = shape
        rounds = max(c["n_estimators"] for c in combos if (c["learning_rate"], c["max_depth"]) == shape)
        rest, ones, trees = y - y.mean(), np.ones(len(x)), []
        for _ in range(rounds):
            (step,) = grow(x, rest, ones, [(depth, 2)])
            trees.append(step)
            rest = rest - rate * evaluate(step, x)
        found[shape] = trees
    return [found[c["learning_rate"], c["max_depth"]][: c["n_estimators"]] for c in combos]


def ensembles(kind: str, x: np.ndarray, y: np.ndarray, combos: list[dict]) -> list[Step]:
    """The fitted step function of every setting."""
    if kind == "gbt":
        return [add_up(t, c["learning_rate"], float(y.mean())) for t, c in zip(boosted(x, y, combos), combos)]
    return [add_up(t, 1 / len(t)) for t in forests(x, y, combos)]


# -- one series -------------------------------------------------------------
def fit_series(x: np.ndarray, y: np.ndarray, kind: str, full_grid: bool, train_ratio: float, n_folds: int) -> dict | None:
    """Search, fit and score one series (rows sorted by ``x``, NaN for no
    target); None if it can't be scored."""
    n_train = math.floor(train_ratio * len(x))
    if n_train < n_folds or n_train >= len(x):
        return None
    real = ~np.isnan(y)
    own, extra = divmod(n_train, n_folds)
    fold = np.repeat(np.arange(n_folds), [own + (k < extra) for k in range(n_folds)])
    fold = np.concatenate([fold, np.full(len(x) - n_train, -1)])
    combos = settings(kind, full_grid)
    train, test = real & (fold >= 0), real & (fold < 0)
    if not train.any() or not test.any():
        return None
    losses = []
    for k in range(n_folds):
        fit, check = train & (fold != k), train & (fold == k)
        if fit.any() and check.any():
            steps = ensembles(kind, x[fit], y[fit], combos)
            losses.append([float(np.mean((y[check] - evaluate(s, x[check])) ** 2)) for s in steps])
    if not losses:
        return None
    mean = np.mean(losses, axis=0)
    best = min(range(len(combos)), key=lambda i: (float(RANK_FORMAT % mean[i]), i))
    bounds, values = ensembles(kind, x[train], y[train], [combos[best]])[0]
    error = y[test] - evaluate((bounds, values), x[test])
    return {
        "model": KINDS[kind][0],
        "grid_pos": best,
        "best_params": json.dumps(combos[best]),
        "cv_mse": float(mean[best]),
        "bounds": bounds.tolist(),
        "values": values.tolist(),
        "n_test": int(test.sum()),
        "mse": float(np.mean(error**2)),
        "sse": float(np.sum(error**2)),
        "sst": float(np.sum((y[test] - y[test].mean()) ** 2)),
    }


_FOUND = [
    StructField("model", StringType()),
    StructField("grid_pos", LongType()),
    StructField("best_params", StringType()),
    StructField("cv_mse", DoubleType()),
    StructField("bounds", ArrayType(DoubleType())),
    StructField("values", ArrayType(DoubleType())),
    StructField("n_test", LongType()),
    StructField("mse", DoubleType()),
    StructField("sse", DoubleType()),
    StructField("sst", DoubleType()),
]


# -- all series -------------------------------------------------------------
def fit_tree_models(
    series: DataFrame,
    key_cols: list[str],
    x: str,
    y: str,
    kinds: tuple[str, ...] = ("random_forest", "gbt"),
    full_grid: bool = True,
    train_ratio: float = DEFAULT_TRAIN_RATIO,
    n_folds: int = DEFAULT_FOLDS,
) -> DataFrame:
    """Per key and kind, the grid's winner (lowest mean validation MSE, ties:
    first in grid order) fitted on all train rows: ``(keys, model, grid_pos,
    best_params, cv_mse, bounds, values, n_test, mse, sse, sst)``. The table is
    the model: S4 writes it as it is. Keys that can't be scored have no row."""
    _check_keys(key_cols)
    schema = StructType([series.schema[c] for c in key_cols] + _FOUND)
    names = [f.name for f in schema]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_x", kind="stable")
        keys = frame[key_cols].iloc[0].tolist()
        values = frame["_x"].to_numpy(float), frame["_y"].to_numpy(float)
        found = [fit_series(*values, kind, full_grid, train_ratio, n_folds) for kind in kinds]
        return pd.DataFrame([[*keys, *f.values()] for f in found if f is not None], columns=names)

    rows = series.select(*key_cols, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    return rows.groupBy(*key_cols).applyInPandas(run, schema)


def step_value(bounds: str, values: str, x: str) -> Column:
    """The value of a step function (two array columns) at ``x``."""
    return F.expr(f"element_at({values}, 1 + size(filter({bounds}, b -> b < {x})))")


def tree_test_metrics(
    series: DataFrame,
    key_cols: list[str],
    x: str,
    y: str,
    kind: str = "random_forest",
    full_grid: bool = True,
) -> DataFrame:
    """M6/M7 scored like M9: per key ``(model, best_params, mse, rmse, r2)`` of
    the key's winner on its held-out tail, NULLs with a ``reason`` for keys that
    can't be scored."""
    found = _metrics(fit_tree_models(series, key_cols, x, y, (kind,), full_grid), key_cols)
    return _with_unscored(found, series, key_cols, DEFAULT_TRAIN_RATIO, DEFAULT_FOLDS)


def _metrics(models: DataFrame, key_cols: list[str]) -> DataFrame:
    r2 = _r2(F.col("n_test"), F.col("sse"), F.col("sst"))
    return models.select(*key_cols, "model", "best_params", "mse", F.sqrt("mse").alias("rmse"), r2.alias("r2"))


def leaderboard_with_trees(
    series: DataFrame,
    key_cols: list[str],
    x: str,
    y: str,
    full_grid: bool = True,
) -> DataFrame:
    """M10 with the tree ensembles: per key, the winners of the linear family,
    the random forest and gradient boosting, ranked by held-out RMSE (ten
    significant digits; ties: model name). Output ``(keys, model, best_params,
    rmse, r2, rank, reason)``; keys that can't be scored have a row of NULLs."""
    linear = test_metrics(series, key_cols, x, y)
    trees = _metrics(fit_tree_models(series, key_cols, x, y, full_grid=full_grid), key_cols)
    both = linear.unionByName(trees.withColumn("reason", F.lit(None).cast("string")))
    rank = F.when(F.col("model").isNotNull(), F.row_number().over(_by_rmse(key_cols)).cast("int"))
    return both.select(*key_cols, "model", "best_params", "rmse", "r2", rank.alias("rank"), "reason")


def _by_rmse(key_cols: list[str]):
    order = significant(F.col("rmse")).asc_nulls_last(), F.col("model").asc_nulls_last()
    return Window.partitionBy(*key_cols).orderBy(*order)


def best_of_all_forecast(
    series: DataFrame,
    key_cols: list[str],
    x: str,
    y: str,
    n_periods: int = 3,
    full_grid: bool = True,
    value_col: str = "forecast",
) -> DataFrame:
    """M11-M13 from the leaderboard's first model, whatever its kind: one table
    holds a line (slope, intercept) or a step function (bounds, values) for each
    key, and the forecast takes the one there is. Output ``(keys, month, t,
    <value_col>, model, reason)``."""
    line = _ranked(series, key_cols, x, y, DEFAULT_TRAIN_RATIO, DEFAULT_FOLDS)
    line = line.select(*key_cols, "model", "rmse", "slope", "intercept")
    steps = fit_tree_models(series, key_cols, x, y, full_grid=full_grid)
    steps = steps.select(*key_cols, "model", F.sqrt("mse").alias("rmse"), "bounds", "values")
    models = line.unionByName(steps, allowMissingColumns=True)
    first = models.withColumn("_rank", F.row_number().over(_by_rmse(key_cols))).where("_rank = 1")
    last = series.groupBy(*key_cols).agg(F.max(x).alias("last_t"), F.max("timestamp_month").alias("last_month"))
    ahead = last.join(first, key_cols).withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(int(n_periods)))))
    ahead = ahead.withColumn("t", (F.col("last_t") + F.col("h")).cast("int"))
    value = F.when(F.col("values").isNotNull(), step_value("bounds", "values", "t")).otherwise(F.expr("intercept + slope * t"))
    found = create_forecast_calendar(ahead.withColumn("forecast", value), key_cols, value_col, ("model",))
    return _with_unscored(found, series, key_cols, DEFAULT_TRAIN_RATIO, DEFAULT_FOLDS)
