"""Profiling semantics on hand-made frames."""

from __future__ import annotations

import datetime as dt

from playlens.operators import profile

from conftest import PLAYS_DDL


def _plays(spark, rows):
    return spark.createDataFrame(rows, PLAYS_DDL)


ROWS = [
    ("10", dt.datetime(2008, 12, 31, 23, 0), "m1", "Abba", "t1", "Song"),
    ("9", dt.datetime(2009, 1, 2, 22, 59, 59), None, "Abba", "t2", "Song"),
    (None, dt.datetime(2009, 1, 1, 0, 0), "m2", "Zed", "t3", None),
    ("10", None, "m1", "Abba", "t4", "Other"),
]


def test_null_report_and_row_count(spark):
    p = _plays(spark, ROWS)
    assert profile.row_count(p).collect()[0]["n_rows"] == 4
    nulls = {r["column"]: (r["null_count"], r["null_pct"]) for r in profile.null_report(p).collect()}
    assert nulls["userid"] == (1, 25.0) and nulls["timestamp"] == (1, 25.0)
    assert nulls["musicbrainz_artist_id"] == (1, 25.0) and nulls["artist_name"] == (0, 0.0)


def test_column_summary_is_lexicographic_and_numeric_aware(spark):
    summ = {r["column"]: r for r in profile.column_summary(_plays(spark, ROWS)).collect()}
    u = summ["userid"]
    assert (u["count"], u["min"], u["max"]) == (3, "10", "9")  # strings compare as text
    assert abs(u["mean"] - 29 / 3) < 1e-6  # mean over values that read as numbers
    a = summ["artist_name"]
    assert a["mean"] is None and (a["min"], a["max"]) == ("Abba", "Zed")
    assert "timestamp" not in summ


def test_date_range_floors_whole_days(spark):
    r = profile.date_range(_plays(spark, ROWS)).collect()[0]
    assert r["min_date"] == dt.datetime(2008, 12, 31, 23, 0)
    assert r["max_date"] == dt.datetime(2009, 1, 2, 22, 59, 59)
    assert r["duration_days"] == 1  # 47 h 59 min 59 s


def test_yearly_activity_has_a_null_year(spark):
    got = [(r["year"], r["track_count"]) for r in profile.activity_by_year(_plays(spark, ROWS)).collect()]
    assert got == [(None, 1), (2008, 1), (2009, 2)]


def test_distinct_users_counts_null(spark):
    assert profile.distinct_users(_plays(spark, ROWS)).collect()[0]["n_users"] == 3


def test_top_artists_and_tracks_ties(spark):
    p = _plays(spark, ROWS)
    assert [tuple(r) for r in profile.top_artists(p, 2).collect()] == [("Abba", 3), ("Zed", 1)]
    got = [tuple(r) for r in profile.top_tracks(p, 3).collect()]
    assert got == [("Song", "Abba", 2), (None, "Zed", 1), ("Other", "Abba", 1)]


def test_user_activity_stats(spark):
    r = profile.user_activity_stats(_plays(spark, ROWS)).collect()[0]
    assert (r["count"], r["min"], r["max"]) == (3, 1, 2)  # users 10 (2 plays), 9, NULL
