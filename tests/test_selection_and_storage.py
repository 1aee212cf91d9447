"""Model selection without units, missing values, short keys, long horizons,
shared storage and exact text files."""

from __future__ import annotations

import datetime as dt
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from session_reference import session_ids_by_definition

from playlens import config
from playlens.operators import seasonal, series, sessions, trees, trend
from playlens.sources import plays as P
from playlens.sources import sinks

KEY, T = ["key"], "count_months"


def make_series(spark, values: dict[str, list], name="key"):
    rows = [
        (k, i, None if v is None else float(v), dt.datetime(2000 + i // 12, i % 12 + 1, 1))
        for k, vs in values.items()
        for i, v in enumerate(vs)
    ]
    return spark.createDataFrame(rows, f"`{name}` string, {T} int, y double, timestamp_month timestamp_ntz")


def noisy(seed, n=60):
    rng = random.Random(seed)
    return [30 + 0.4 * i + rng.gauss(0, 6) for i in range(n)]


def test_winners_do_not_depend_on_the_unit(spark):
    base = {f"k{i}": noisy(i) for i in range(4)}
    boards = []
    for scale in (1.0, 1e-3, 1e-4, 1e5):
        df = make_series(spark, {k: [v * scale for v in vs] for k, vs in base.items()})
        found = trend.grid_search(df, KEY, T, "y").where("model IN ('Ridge', 'LinearRegression')").collect()
        boards.append(sorted((r["key"], r["model"], r["grid_pos"]) for r in found))
    assert all(b == boards[0] for b in boards)


def test_scores_keep_full_precision(spark):
    df = make_series(spark, {"k": [v * 1e-6 for v in noisy(7)]})
    r = trend.leaderboard(df, KEY, T, "y").where("rank = 1").first()
    assert 0 < r["rmse"] < 1e-4 and r["rmse"] != round(r["rmse"], 6)


def test_null_targets_take_no_part_in_fits(spark):
    whole = make_series(spark, {"k": [2 * i + 1 for i in range(30)]})
    gap = whole.unionByName(make_series(spark, {"k": [None] * 35}).where(f"{T} > 30"))
    for fit in (trend.fit_linear_regression, trend.fit_ridge, trend.fit_lasso):
        a, b = ([(r["slope"], r["intercept"], r["n_train"]) for r in fit(df, KEY, T, "y").collect()] for df in (whole, gap))
        assert a == b


def test_sessions_without_a_month_do_not_shift_the_series(spark):
    months = [(1, dt.datetime(2020, 1, 1)), (1, dt.datetime(2020, 2, 1)), (1, None)]
    df = spark.createDataFrame(months, "userid int, timestamp_month timestamp_ntz")
    got = [(r["timestamp_month"], r["count_months"]) for r in series.add_month_counter(df).orderBy("count_months").collect()]
    assert got == [(dt.datetime(2020, 1, 1), 0), (dt.datetime(2020, 2, 1), 1)]


def test_key_columns_may_have_short_names(spark):
    base = trend.leaderboard(make_series(spark, {"a": noisy(1)}), KEY, T, "y").drop("key").collect()
    for name in ("k", "m", "pos", "x"):
        got = trend.leaderboard(make_series(spark, {"a": noisy(1)}, name), [name], T, "y").drop(name).collect()
        assert sorted(map(str, got)) == sorted(map(str, base))
    with pytest.raises(ValueError):
        trend.leaderboard(make_series(spark, {"a": noisy(1)}, "mse"), ["mse"], T, "y")


def test_unscored_keys_have_a_reason(spark):
    df = make_series(spark, {"long": noisy(1), "short": [1, 2, 3]})
    for found in (trend.grid_search(df, KEY, T, "y"), trend.test_metrics(df, KEY, T, "y"), trend.leaderboard(df, KEY, T, "y")):
        rows = found.where("key = 'short'").collect()
        assert [(r["model"], r["reason"]) for r in rows] == [(None, "fewer train rows than folds")]
        assert found.where("key = 'long' AND reason IS NULL").count() == 3
    all_train = trend.leaderboard(df, KEY, T, "y", train_ratio=1.0).where("key = 'long'").collect()
    assert {r["reason"] for r in all_train} <= {None, "no test rows"} and all_train


def test_long_horizons(spark):
    values = [float((i * 7) % 11) + 0.3 * i for i in range(40)]
    df = make_series(spark, {"k": values})
    got = [r["forecast"] for r in seasonal.seasonal_forecast(df, KEY, T, "y", periods=30).orderBy("t").collect()]
    y = np.array(values)
    u = y[12:] - y[:-12]
    w = np.diff(u)
    phi = (w[1:] @ w[:-1]) / (w[:-1] @ w[:-1])
    extended, ut, wt = list(values), u[-1], w[-1]
    for _ in range(30):
        wt *= phi
        ut += wt
        extended.append(extended[-12] + ut)
    assert np.allclose(got, extended[40:], atol=1e-9)
    coefs = spark.createDataFrame([("k", 1.0, 0.0)], "key string, slope double, intercept double")
    assert trend.forecast_future_periods(df, coefs, KEY, T, 150).count() == 150


def test_top_n_has_no_cap(make_plays):
    rows = [(f"u{i}", 10_000 * j + s, f"t{(i + s) % 30}") for i in range(30) for j in range(20) for s in (0, 60)]
    p = make_plays(rows)
    got = sessions.top_tracks_by_index(p, 1200, 501, 120).collect()
    slow = sessions.top_tracks_from_sessions(session_ids_by_definition(p, 1200), 501, 120).collect()
    assert got == slow


def test_numbering_by_ranges_equals_the_definition(make_plays):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, rng.randrange(0, 400_000)]), "t") for _ in range(600)]
    p = make_plays(rows)
    for gap in (0, 17, 1200, 90_000):
        a = sessions.add_session_ids(p, gap).select("musicbrainz_track_id", "session_id")
        b = session_ids_by_definition(p, gap).select("musicbrainz_track_id", "session_id")
        assert sorted(a.collect()) == sorted(b.collect())


# -- diagnostics ------------------------------------------------------------
def by_normal_equations(y, lags, skip):
    dy = np.diff(y)
    rows = range(skip, len(dy))
    x = np.array([[y[t], *[dy[t - i] for i in range(1, lags + 1)], 1.0] for t in rows])
    z = dy[skip:]
    beta = np.linalg.solve(x.T @ x, x.T @ z)
    e = z - x @ beta
    se = np.sqrt(e @ e / (len(z) - x.shape[1]) * np.linalg.inv(x.T @ x)[0, 0])
    return len(z) * np.log(e @ e / len(z)) + 2 * x.shape[1], len(z), beta[0] / se


@pytest.mark.parametrize("seed", range(3))
def test_lag_search_equals_normal_equations(spark, seed):
    rng = np.random.default_rng(seed)
    y = [0.0, 0.0, 0.0]
    for _ in range(77):
        y.append(0.5 * y[-1] + 0.3 * y[-3] + rng.normal())
    y = np.array(y)
    top = int(np.ceil(12 * (len(y) / 100) ** 0.25))
    best = min(range(top + 1), key=lambda k: by_normal_equations(y, k, top)[0])
    _, n_obs, statistic = by_normal_equations(y, best, best)
    r = seasonal.stationarity_autolag(make_series(spark, {"k": y.tolist()}), KEY, T, "y").first()
    assert (r["used_lag"], r["n_obs"]) == (best, n_obs)
    assert abs(r["adf_statistic"] - statistic) < 1e-8
    assert r["is_stationary"] == (r["p_value"] < 0.05)


def test_p_values_at_published_points(spark):
    """The 1, 5 and 10 % asymptotic critical values, constant and no trend."""
    df = spark.createDataFrame([(-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10), (-20.0, 0.0), (3.0, 1.0)], "t double, p double")
    for r in df.withColumn("got", seasonal.dickey_fuller_p(F.col("t"))).collect():
        assert abs(r["got"] - r["p"]) < 0.002


def test_short_and_constant_series_have_reasons(spark):
    df = make_series(spark, {"two": [1, 2], "flat": [3] * 30})
    for found in (seasonal.stationarity(df, KEY, T, "y"), seasonal.stationarity_autolag(df, KEY, T, "y")):
        rows = {r["key"]: r for r in found.collect()}
        assert set(rows) == {"two", "flat"}
        assert all(r["adf_statistic"] is None and r["reason"] for r in rows.values())


def test_bands_and_lags_follow_the_length(spark):
    y = np.array(noisy(3, 50))
    df = make_series(spark, {"k": y.tolist()})
    got = seasonal.acf(df, KEY, T, "y").orderBy("lag").collect()
    assert len(got) == 1 + min(int(np.ceil(10 * np.log10(50))), 25)
    d = y - y.mean()
    r = np.array([d[: 50 - k] @ d[k:] for k in range(len(got))]) / (d @ d)
    band = [0.0] + [1.959963984540054 * np.sqrt((1 + 2 * (r[1:k] ** 2).sum()) / 50) for k in range(1, len(got))]
    assert np.allclose([g["acf"] for g in got], r) and np.allclose([g["band"] for g in got], band)
    partial = seasonal.pacf(df, KEY, T, "y").collect()
    assert len(partial) == 17 and all(abs(p["band"] - 1.959963984540054 / np.sqrt(50)) < 1e-12 for p in partial)


def test_a_forest_does_not_depend_on_partitions(spark):
    df = make_series(spark, {"a": noisy(1, 40), "b": noisy(2, 40)})
    boards = []
    for parts in (1, 5):
        found = trees.tree_test_metrics(df.repartition(parts), KEY, T, "y", "random_forest", full_grid=False)
        boards.append(sorted((r["key"], r["rmse"]) for r in found.collect()))
    assert boards[0] == boards[1]


# -- storage ----------------------------------------------------------------
class _Session:
    """A session with a master and without a checkpoint folder."""

    def __init__(self, master):
        self.conf, self.sparkContext, self.master = self, self, master

    def get(self, key, default=None):
        return default

    def getCheckpointDir(self):  # noqa: N802
        return None


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        config.checkpoint_root(_Session(master))


def test_stored_steps_are_removed(spark):
    stored = config.materialize(spark.range(10), "x")
    folder = config.scratch_root(spark).removeprefix("file:")
    assert stored.count() == 10 and os.path.isdir(folder)
    before = spark.conf.get(config.SHUFFLE_CLEANUP)
    config.clear_scratch(spark)
    assert not os.path.exists(folder) and spark.conf.get(config.SHUFFLE_CLEANUP) == before


def test_tables_are_read_as_they_are_now(spark, tmp_path):
    folder = str(tmp_path)
    spark.range(5).write.parquet(f"{folder}/events.parquet")
    assert P.table(spark, folder, "events").count() == 5
    spark.range(7).write.mode("append").parquet(f"{folder}/events.parquet")
    assert P.table(spark, folder, "events").count() == 12


def test_exact_text_files(spark, tmp_path):
    texts = ["a\tb\nc\r\\n", None, "", "\\N", "\\E", "\\\\", "tab\\t", "\"q\" 'x'", "  lead trail  ", "\\", "é\\\\\n", "#c"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    sinks.write_tsv(df, f"{tmp_path}/a", single_file=True)
    back = sinks.read_tsv(spark, f"{tmp_path}/a", "i int, t string").orderBy("i").collect()
    assert [r["t"] for r in back] == texts
    plays = spark.createDataFrame([("u", dt.datetime(2024, 1, 1), None, "", "x\ny", "\t")], ", ".join(f"{c} {'timestamp' if c == 'timestamp' else 'string'}" for c in P.PLAY_COLUMNS))
    P.write_raw_tsv(plays, f"{tmp_path}/b", exact=True)
    assert P.load_track_data(spark, f"{tmp_path}/b", exact=True).collect() == plays.collect()
