"""Tree ensembles of a series against a plain recursive version."""

from __future__ import annotations

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from playlens.operators import trees, trend
from test_selection_and_storage import make_series

KEY, T = ["key"], "count_months"


def plain_tree(rows, depth, least):
    """Nested (bound, left, right) or a value, by trying every split; rows are (x, y)."""
    ys = [y for _, y in rows]
    mean = math.fsum(ys) / len(ys)
    xs = sorted({x for x, _ in rows})
    distinct = {x: [y for a, y in rows if a == x] for x in xs}
    if depth == 0 or len(distinct) < least or len(set(ys)) == 1 or len(xs) < 2:
        return mean
    best = None
    for a, b in zip(xs, xs[1:]):
        left, right = [y for x, y in rows if x <= a], [y for x, y in rows if x > a]
        loss = sum(math.fsum((y - math.fsum(p) / len(p)) ** 2 for y in p) for p in (left, right))
        if best is None or loss < best[0] - 1e-9:
            best = loss, (a + b) / 2
    bound = best[1]
    return (
        bound,
        plain_tree([r for r in rows if r[0] <= bound], depth - 1, least),
        plain_tree([r for r in rows if r[0] > bound], depth - 1, least),
    )


def plain_value(tree, x):
    while isinstance(tree, tuple):
        tree = tree[1] if x <= tree[0] else tree[2]
    return tree


def sample(seed, n):
    rng = np.random.default_rng(seed)
    return np.arange(n, dtype=float), 10 + 3 * np.sin(np.arange(n) / 4) + rng.normal(size=n)


@pytest.mark.parametrize("seed", range(3))
def test_forest_equals_plain_trees(seed):
    x, y = sample(seed, 30)
    combos = [c | {"n_estimators": c["n_estimators"] // 20} for c in trees.settings("random_forest")]
    found = trees.forests(x, y, combos, seed)
    rng = np.random.RandomState(seed)
    draws = [rng.randint(0, len(x), len(x)) for _ in range(10)]
    places = np.arange(-3, 40, 0.25)
    for combo, steps in zip(combos, found):
        assert len(steps) == combo["n_estimators"]
        for drawn, step in zip(draws, steps):
            rows = [(x[i], y[i]) for i in drawn]
            tree = plain_tree(rows, math.inf if combo["max_depth"] is None else combo["max_depth"], combo["min_samples_split"])
            assert np.allclose(trees.evaluate(step, places), [plain_value(tree, p) for p in places])


@pytest.mark.parametrize("seed", range(3))
def test_boosting_equals_plain_rounds(seed):
    x, y = sample(seed, 25)
    combos = [c | {"n_estimators": c["n_estimators"] // 10} for c in trees.settings("gbt")]
    places = np.arange(-2, 30, 0.5)
    for combo, step in zip(combos, trees.ensembles("gbt", x, y, combos)):
        now, out = np.full(len(x), y.mean()), np.full(len(places), y.mean())
        for _ in range(combo["n_estimators"]):
            tree = plain_tree(list(zip(x, y - now)), combo["max_depth"], 2)
            now = now + combo["learning_rate"] * np.array([plain_value(tree, p) for p in x])
            out = out + combo["learning_rate"] * np.array([plain_value(tree, p) for p in places])
        assert np.allclose(trees.evaluate(step, places), out)


def test_search_scores_and_winner(spark):
    """Folds, held-out metrics and the choice, from the ensembles of each fold."""
    x, y = sample(5, 36)
    got = trees.tree_test_metrics(make_series(spark, {"a": y.tolist()}), KEY, T, "y", "gbt").first()
    t = make_series(spark, {"a": y.tolist()}).orderBy(T).toPandas()[T].to_numpy(float)
    n = int(0.67 * 36)
    combos, folds = trees.settings("gbt"), np.array_split(np.arange(n), 3)
    losses = np.zeros(len(combos))
    for check in folds:
        fit = np.setdiff1d(np.arange(n), check)
        losses += [np.mean((y[check] - trees.evaluate(s, t[check])) ** 2) / 3 for s in trees.ensembles("gbt", t[fit], y[fit], combos)]
    best = int(np.argmin(np.round(losses, 9)))
    assert json.loads(got["best_params"]) == combos[best]
    error = y[n:] - trees.evaluate(trees.ensembles("gbt", t[:n], y[:n], [combos[best]])[0], t[n:])
    assert math.isclose(got["rmse"], math.sqrt(np.mean(error**2)))
    assert math.isclose(got["r2"], 1 - np.sum(error**2) / np.sum((y[n:] - y[n:].mean()) ** 2))


def test_odd_series(spark):
    """Constant, short, partly empty and empty series."""
    nan = None
    df = make_series(spark, {"flat": [3.0] * 12, "short": [1.0, 2.0], "holes": [1.0, nan, 3.0, 4.0, nan, 6.0, 7.0, 8.0, 9.0, nan, 11.0, 12.0]})
    rows = {r["key"]: r for r in trees.tree_test_metrics(df, KEY, T, "y", "random_forest", full_grid=False).collect()}
    assert rows["flat"]["mse"] == 0 and rows["flat"]["r2"] == 1
    assert rows["short"]["mse"] is None and rows["short"]["reason"] and rows["holes"]["mse"] > 0
    assert trees.fit_tree_models(df.where("false"), KEY, T, "y").count() == 0


def test_forecast_follows_the_first_of_the_leaderboard(spark):
    """A step keeps its last value; a line goes on."""
    steps = [float(5 + 20 * (i >= 30)) for i in range(60)]
    line = [2.0 * i + 1 for i in range(40)]
    df = make_series(spark, {"step": steps, "line": line, "short": [1.0]})
    first = {r["key"]: r["model"] for r in trees.leaderboard_with_trees(df, KEY, T, "y", full_grid=False).where("rank = 1").collect()}
    rows = trees.best_of_all_forecast(df, KEY, T, "y", full_grid=False).collect()
    for key in ("step", "line"):
        own = sorted((r for r in rows if r["key"] == key), key=lambda r: r["t"])
        assert [r["model"] for r in own] == [first[key]] * 3
    values = lambda key: [round(r["forecast"], 3) for r in sorted((r for r in rows if r["key"] == key), key=lambda r: r["t"])]
    assert first["step"] in ("RandomForestRegressor", "GradientBoostingRegressor") and np.allclose(values("step"), 25, atol=0.1)
    start = trend.forecast_future_periods(df.where("key = 'line'"), spark.createDataFrame([("line", 2.0, 0.0)], "key string, slope double, intercept double"), KEY, T)
    assert np.allclose(np.diff(values("line")), 2, atol=0.01) and start.count() == 3
    assert [(r["forecast"], bool(r["reason"])) for r in rows if r["key"] == "short"] == [(None, True)]


def test_stored_models_predict_the_same(spark, tmp_path):
    df = make_series(spark, {"a": sample(1, 40)[1].tolist(), "b": sample(2, 40)[1].tolist()})
    models = trees.fit_tree_models(df, KEY, T, "y", ("gbt",), full_grid=False)
    models.write.parquet(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    rows = df.join(stored, KEY).select("key", F.col(T).alias("x"), trees.step_value("bounds", "values", T).alias("v")).collect()
    local = {r["key"]: (np.array(r["bounds"]), np.array(r["values"])) for r in models.collect()}
    assert all(math.isclose(r["v"], trees.evaluate(local[r["key"]], np.array([float(r["x"])]))[0]) for r in rows)
