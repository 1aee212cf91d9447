"""The series on a regular calendar, and the session index that grows by batches."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from playlens.config import scratch_path
from playlens.operators import series, sessions, sessionstore


def month(m, y=2024):
    return dt.datetime(y, m, 1)


@pytest.mark.parametrize(
    "fill,values",
    [
        ("null", [2.0, None, None, None, 8.0, 1.0]),
        ("zero", [2.0, 0.0, 0.0, 0.0, 8.0, 1.0]),
        ("previous", [2.0, 2.0, 2.0, 2.0, 8.0, 1.0]),
        ("linear", [2.0, 3.5, 5.0, 6.5, 8.0, 1.0]),
    ],
)
def test_missing_months_are_filled(spark, fill, values):
    rows = [("a", month(11, 2023), 2.0), ("a", month(1), None), ("a", month(3), 8.0), ("a", month(4), 1.0), ("a", None, 9.0), (None, month(5), 4.0)]
    monthly = spark.createDataFrame(rows, "userid string, timestamp_month timestamp_ntz, avg_session_duration_sec double")
    got = series.fill_calendar(monthly, fill=fill).orderBy("userid", "timestamp_month").collect()
    assert [tuple(r) for r in got[:1]] == [(None, month(5), 0, 4.0, False)]
    assert [r["avg_session_duration_sec"] for r in got[1:]] == values
    assert [r["timestamp_month"] for r in got[1:]] == [month(11, 2023), month(12, 2023), month(1), month(2), month(3), month(4)]
    assert [r["count_months"] for r in got[1:]] == list(range(6))
    assert [r["filled"] for r in got[1:]] == [False, True, True, True, False, False]
    assert series.fill_calendar(monthly.where("false"), fill=fill).count() == 0


def test_unknown_fill_raises(spark):
    with pytest.raises(ValueError):
        series.fill_calendar(spark.createDataFrame([], "userid string, timestamp_month timestamp"), fill="mean")


@pytest.mark.parametrize("gap", [0, 30, 1200])
def test_batches_give_the_index_of_the_whole(spark, make_plays, gap):
    rng = random.Random(gap)
    rows = [(rng.choice(["u", "v", None]), rng.choice([None, rng.random() * 20000]), "t") for _ in range(400)]
    path = scratch_path(spark, "store-test")
    for name, part in (("b", rows[250:]), ("a", rows[:100]), ("c", rows[:7]), ("c", rows[100:250])):
        sessionstore.append_plays(make_plays(part), path, name, gap)
    columns = ["userid", "bucket", "first_ts", "first_sec", "last_sec", "n_plays", "session_id"]
    want = sessions.session_index(make_plays(rows), gap).select(columns)
    got = sessionstore.stored_index(spark, path, gap).select(columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
