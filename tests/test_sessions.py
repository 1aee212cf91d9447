"""Session semantics on hand-made frames (FIXTURES.md §4) and invariants."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from session_reference import session_ids_by_definition

from playlens.operators import sessions as S
from playlens.operators.series import top_user, user_with_longest_session


def _ids(df):
    return [r["session_id"] for r in df.orderBy("musicbrainz_track_id").collect()]


def test_gap_equal_to_limit_stays_in_session(make_plays):
    p = make_plays([("u", 0, "a"), ("u", 1200, "b"), ("u", 2401, "c")])
    assert _ids(S.add_session_ids(p, 1200)) == [0, 0, 1]


def test_fractional_seconds_are_dropped_before_subtracting(make_plays):
    # 00:00:00.9 -> 00:20:01.1 is 1200.2 s, but 1201 whole seconds: a new session
    p = make_plays([("u", 0.9, "a"), ("u", 1201.1, "b")])
    assert _ids(S.add_session_ids(p, 1200)) == [0, 1]


def test_duplicate_times_share_a_session(make_plays):
    p = make_plays([("u", 0, "a"), ("u", 5000, "b"), ("u", 5000, "c"), ("u", 5001, "d")])
    assert _ids(S.add_session_ids(p, 1200)) == [0, 1, 1, 1]


def test_null_timestamps_sort_first_in_session_zero(make_plays):
    p = make_plays([("u", None, "a"), ("u", 100, "b"), ("u", 5000, "c"), ("u", None, "d")])
    assert _ids(S.add_session_ids(p, 1200)) == [0, 0, 1, 0]


def test_null_user_is_its_own_partition(make_plays):
    p = make_plays([(None, 0, "a"), (None, 5000, "b"), ("u", 0, "c")])
    assert _ids(S.add_session_ids(p, 1200)) == [0, 1, 0]


def test_empty_input(spark, make_plays):
    p = make_plays([("u", 0, "a")]).limit(0)
    s = S.add_session_ids(p, 1200)
    assert s.count() == 0
    assert S.session_count(s).collect()[0]["session_count"] == 0
    assert top_user(s).count() == 0
    assert S.top_tracks_from_longest_sessions(s, 5, 5).count() == 0


def test_index_plan_equals_per_user_window_on_random_plays(make_plays):
    rng = random.Random(7)
    rows = []
    for i in range(600):
        user = rng.choice(["a", "b", "c", None])
        sec = None if rng.random() < 0.03 else rng.choice([rng.uniform(0, 400), rng.randint(0, 400)])
        rows.append((user, sec, f"t{rng.randint(0, 5)}"))
    p = make_plays(rows)
    for gap in (0, 1, 3, 5, 11, 40, 1000):
        a = S.add_session_ids(p, gap).select("musicbrainz_track_id", "session_id")
        b = session_ids_by_definition(p, gap).select("musicbrainz_track_id", "session_id")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, gap
        for rank_by in ("duration", "plays"):
            fast = S.top_tracks_by_index(p, gap, 4, 10, rank_by=rank_by)
            slow = S.top_tracks_from_sessions(session_ids_by_definition(p, gap), 4, 10, rank_by=rank_by)
            assert fast.collect() == slow.collect(), (gap, rank_by)


def test_invariants_on_events(spark):
    from playlens.sources.plays import event_plays

    plays = event_plays(spark, "/root/testdata/sf0.01")
    n = plays.count()
    counts = []
    for gap in (600, 1200, 21600):
        s = S.add_session_ids(plays, gap)
        d = S.compute_session_duration(s, with_play_count=True)
        assert d.agg(F.sum("n_plays")).collect()[0][0] == n
        per_user = s.groupBy("userid").agg(
            (F.max("session_id") + 1).alias("a"), F.countDistinct("session_id").alias("b")
        )
        assert per_user.filter(F.col("a") != F.col("b")).count() == 0
        counts.append(S.session_count(s).collect()[0]["session_count"])
    assert counts == sorted(counts, reverse=True)
    assert counts[1] == 9693  # 20 minutes (FIXTURES.md §3)


def test_session_window_cross_check(spark):
    """E1 against Spark's own session_window on whole seconds (touching windows merge)."""
    from playlens.sources.plays import event_plays

    plays = event_plays(spark, "/root/testdata/sf0.01")
    sw = (
        plays.withColumn("sec_ts", F.date_trunc("second", "timestamp"))
        .groupBy("userid", F.session_window("sec_ts", "1200 seconds"))
        .count()
        .count()
    )
    assert sw == S.session_count(S.add_session_ids(plays, 1200)).collect()[0][0]


def test_top_tracks_semantics(make_plays):
    rows = [
        # user a: session 0 lasts 100 s (x, x, y), session 1 is one play (z)
        ("a", 0, "x"), ("a", 50, "x"), ("a", 100, "y"), ("a", 5000, "z"),
        # user b: session 0 lasts 300 s (y, NULL track, y)
        ("b", 0, "y"), ("b", 150, None), ("b", 300, "y"),
        # NULL user: a very long session that must not join
        (None, 0, "q"), (None, 1000, "q"), (None, 2000, "q"),
    ]
    s = S.add_session_ids(make_plays(rows), 1200)
    got = [(r["track_name"], r["play_count"]) for r in S.top_tracks_from_longest_sessions(s, 3, 10).collect()]
    # top 3 sessions by duration: NULL-user (2000 s, dropped at the join), b/0, a/0
    assert got == [("y", 3), ("x", 2), (None, 1)]
    by_plays = S.top_tracks_from_most_played_sessions(s, 1, 10).collect()
    # most plays: NULL user's session and a/0 and b/0 all have 3; duration breaks it -> NULL user first
    assert by_plays == []


def test_longest_user_and_top_user(make_plays):
    rows = [("a", 0, "x"), ("a", 5000, "x"), ("a", 10000, "x"), ("b", 0, "y"), ("b", 900, "y")]
    s = S.add_session_ids(make_plays(rows), 1200)
    assert [tuple(r) for r in top_user(s).collect()] == [("a", 3)]
    r = user_with_longest_session(s).collect()[0]
    assert (r["userid"], r["longest_session_sec"]) == ("b", 900)


def test_hot_user_index_is_bounded_by_time_not_plays(spark):
    """A third of all plays moved to one user: the session index keeps one
    row per active gap-length bucket for that user, and results still equal
    the textbook per-user window."""
    from playlens.sources.plays import event_plays

    plays = event_plays(spark, "/root/testdata/sf0.01")
    hot = plays.withColumn(
        "userid",
        F.when(F.abs(F.hash("musicbrainz_track_id")) % 3 == 0, F.lit("hot")).otherwise(F.col("userid")),
    )
    gap = 1200
    idx = S.session_index(hot, gap)
    hot_rows = idx.filter(F.col("userid") == "hot").count()
    hot_plays = hot.filter(F.col("userid") == "hot").count()
    span = hot.filter(F.col("userid") == "hot").agg(
        (F.max(F.col("timestamp").cast("long")) - F.min(F.col("timestamp").cast("long"))).alias("s")
    ).collect()[0]["s"]
    assert hot_plays > 3000
    assert hot_rows <= span // gap + 1 < hot_plays
    a = S.add_session_ids(hot, gap).select("musicbrainz_track_id", "session_id")
    b = session_ids_by_definition(hot, gap).select("musicbrainz_track_id", "session_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    fast = S.top_tracks_by_index(hot, gap, 50, 10).collect()
    slow = S.top_tracks_from_sessions(session_ids_by_definition(hot, gap), 50, 10).collect()
    assert fast == slow


def test_session_index_property(spark):
    """Property test: for random plays and gaps, the index plan equals the
    textbook window plan."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from conftest import PLAYS_DDL, ts

    play = st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 5000)))

    @settings(max_examples=15, deadline=None)
    @given(st.lists(play, min_size=0, max_size=40), st.integers(0, 1500))
    def check(rows, gap):
        data = [(u, None if s is None else ts(s), None, "x", f"id{i}", "t") for i, (u, s) in enumerate(rows)]
        p = spark.createDataFrame(data, PLAYS_DDL)
        a = sorted(tuple(r) for r in S.add_session_ids(p, gap).select("musicbrainz_track_id", "session_id").collect())
        b = sorted(
            tuple(r)
            for r in session_ids_by_definition(p, gap).select("musicbrainz_track_id", "session_id").collect()
        )
        assert a == b

    check()


def test_two_level_numbering_across_super_buckets(make_plays, monkeypatch):
    """Small gaps use a second level over super-buckets; a 17-second
    super-bucket puts boundaries everywhere in a small fixture."""
    monkeypatch.setattr(S, "SUPER_BUCKET_SEC", 17)
    rng = random.Random(11)
    rows = []
    for i in range(700):
        user = rng.choice(["hot", "hot", "hot", "b", None])
        sec = None if rng.random() < 0.02 else rng.choice([rng.uniform(0, 900), rng.randint(0, 900)])
        rows.append((user, sec, f"t{rng.randint(0, 4)}"))
    p = make_plays(rows)
    for gap in (0, 1, 2, 5, 9, 30, 59):
        a = S.add_session_ids(p, gap).select("musicbrainz_track_id", "session_id")
        b = session_ids_by_definition(p, gap).select("musicbrainz_track_id", "session_id")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, gap
    fast = S.top_tracks_by_index(p, 5, 20, 5).collect()
    slow = S.top_tracks_from_sessions(session_ids_by_definition(p, 5), 20, 5).collect()
    assert fast == slow
