"""User series and series-model edge cases (FIXTURES.md §4: series)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from session_reference import session_ids_by_definition

from playlens.operators import seasonal, series, trend
from playlens.operators import sessions as S

KEY = "k"
SCHEMA = f"{KEY} string, timestamp_month timestamp_ntz, count_months int, y double"


def _months(n, start=(2020, 1), skip=()):
    y, m = start
    out = []
    for _ in range(n):
        if (y, m) not in skip:
            out.append(dt.datetime(y, m, 1))
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return out


def _series_df(spark, key, values, months=None):
    months = months or _months(len(values))
    return spark.createDataFrame(
        [(key, mo, i, float(v)) for i, (mo, v) in enumerate(zip(months, values))], SCHEMA
    )


def test_month_counter_counts_present_months(spark):
    months = _months(5, skip={(2020, 3)})  # March missing
    df = spark.createDataFrame([("u", mo, 1.0) for mo in months], "userid string, timestamp_month timestamp_ntz, v double")
    got = [r["count_months"] for r in series.add_month_counter(df).orderBy("timestamp_month").collect()]
    assert got == [0, 1, 2, 3]


def test_seasonal_minimum_points(spark):
    short = _series_df(spark, "short", [float(i % 5) for i in range(14)])
    ok = _series_df(spark, "ok", [float((i * 7) % 11) for i in range(15)])
    fc = seasonal.seasonal_forecast(short.unionByName(ok), [KEY], "count_months", "y", periods=3)
    rows = fc.collect()
    assert {r[KEY] for r in rows if r["reason"] is None} == {"ok"}
    assert [(r["t"], r["forecast"], r["reason"]) for r in rows if r[KEY] == "short"] == [(None, None, "fewer than 15 points")]


def test_forecast_months_cross_year_end(spark):
    s = _series_df(spark, "u", [1.0, 2.0, 3.0], months=[dt.datetime(2020, 9, 1), dt.datetime(2020, 10, 1),
                                                          dt.datetime(2020, 11, 1)])
    coefs = spark.createDataFrame([("u", 1.0, 0.0)], f"{KEY} string, slope double, intercept double")
    fc = trend.forecast_future_periods(s, coefs, [KEY], "count_months", 3)
    rows = trend.create_forecast_calendar(fc, [KEY], "v").orderBy("t").collect()
    assert [r["month"] for r in rows] == [dt.datetime(2020, 12, 1), dt.datetime(2021, 1, 1), dt.datetime(2021, 2, 1)]
    assert [r["t"] for r in rows] == [3, 4, 5] and [r["v"] for r in rows] == [3.0, 4.0, 5.0]


def test_constant_series_diagnostics_do_not_fail(spark):
    s = _series_df(spark, "c", [2.0] * 20)
    acf = seasonal.acf(s, [KEY], "count_months", "y", 5).collect()
    assert all(r["acf"] is None for r in acf)  # zero variance: undefined, not an error
    st = seasonal.stationarity(s, [KEY], "count_months", "y").collect()
    assert len(st) == 1 and st[0]["adf_statistic"] is None
    fc = seasonal.seasonal_forecast(s, [KEY], "count_months", "y", periods=2).collect()
    assert [r["forecast"] for r in fc] == [2.0, 2.0]


def test_user_sessions_from_index_equals_rows(spark):
    from playlens.sources.plays import order_plays

    plays = order_plays(spark, "/root/testdata/sf0.01")
    gap = 90 * 86400
    a = series.user_sessions_from_index(S.session_index(plays, gap))
    b = series.user_sessions(session_ids_by_definition(plays, gap))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_top_user_series_is_the_top_users(spark):
    from playlens.sources.plays import order_plays

    plays = order_plays(spark, "/root/testdata/sf0.01")
    idx = S.session_index(plays, 90 * 86400)
    top = series.top_user(idx).collect()[0]
    s = series.top_user_monthly_series(idx, per_session=series.user_sessions_from_index(idx))
    rows = s.orderBy("count_months").collect()
    assert {r["userid"] for r in rows} == {top["userid"]}
    assert [r["count_months"] for r in rows] == list(range(len(rows)))
    assert s.agg(F.count(F.lit(1))).collect()[0][0] <= top["n_sessions"]
