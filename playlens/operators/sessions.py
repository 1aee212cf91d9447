"""Sessions (E1-E9): split each user's plays into sessions by inactivity gap.

A new session starts at a play whose whole-second distance to the user's
previous play (by time) is strictly greater than ``session_gap_sec``; a gap
equal to the limit stays in the session. ``session_id`` is 0-based per user.
Plays with a NULL timestamp sort first and belong to session 0.

Scale design: the session index
-------------------------------
The textbook plan (``lag`` + running ``sum`` over ``Window.partitionBy(user)``)
sorts every play of a user in one task, so one heavy user (a third of all
rows, say) becomes one giant sort. Here no window ever runs over plays.

Cut each user's time line into buckets exactly ``gap`` seconds wide. Two plays
in the same bucket are at most ``gap - 1`` whole seconds apart, so a session
can never start *inside* a bucket: it can only start at the first play of a
bucket, when that play is more than ``gap`` seconds after the last play of
the user's previous non-empty bucket. Hence:

1. ``session_index``: a hash aggregate per (user, bucket) - first and last
   second, first timestamp, play count. Map-side partial aggregation makes a
   heavy user cost the same as a light one; the shuffle carries one row per
   (user, bucket, task).
2. A window over that index, per user ordered by bucket, flags the buckets
   that open a session and numbers them with a running sum. A user has at
   most (time span / gap) buckets, however many plays fall in them.
3. Durations, counts, per-user statistics and session rankings are
   aggregates of the index; plays are only revisited to count tracks of
   selected sessions (``top_tracks_by_index``: a join on user and bucket
   range).

Labelling every play (``add_session_ids``) uses the same idea without the
index: plays are numbered inside (user, day) and get per-day offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions.time import epoch_seconds

DEFAULT_GAP_SEC = 20 * 60

# Internal column names (dropped before returning).
_SEC = "__pl_sec"
_BKT = "__pl_bucket"
_FLAG = "__pl_flag"
_IU = "__pl_index_user"
_IB = "__pl_index_bucket"
_SB = "__pl_super_bucket"
_CUM = "__pl_cum"
_OFF = "__pl_offset"

# Below this gap a user's index can hold a row per active second, so the
# session numbering gets a second level over hour-wide super-buckets.
SMALL_GAP_SEC = 60
SUPER_BUCKET_SEC = 3600
# Width of the time ranges in which plays are numbered (at least the gap).
RANGE_SEC = 86400
_NULL_BUCKET = -(2**63)  # bucket of NULL timestamps: sorts before every real bucket


def _check_gap(session_gap_sec: int) -> int:
    gap = int(session_gap_sec)
    if gap < 0:
        raise ValueError("session_gap_sec must be >= 0")
    return gap


def _bucket(ts_col: str, gap: int) -> Column:
    width = max(gap, 1)  # gap 0: plays in the same second never split
    return F.coalesce(F.floor(epoch_seconds(ts_col) / F.lit(width)), F.lit(_NULL_BUCKET).cast("long"))


def session_index(
    plays: DataFrame,
    session_gap_sec: int = DEFAULT_GAP_SEC,
    user_col: str = "userid",
    ts_col: str = "timestamp",
    session_col: str = "session_id",
) -> DataFrame:
    """One row per (user, gap-wide bucket) holding plays, with its session.

    Columns: ``user_col``, ``bucket``, ``first_sec``, ``last_sec`` (whole
    epoch seconds), ``first_ts`` (earliest timestamp), ``n_plays`` and
    ``session_col``. NULL timestamps form the bucket that sorts first.
    """
    gap = _check_gap(session_gap_sec)
    return number_index(bucket_index(plays, gap, user_col, ts_col), gap, user_col, session_col)


def bucket_index(plays: DataFrame, gap: int, user_col: str = "userid", ts_col: str = "timestamp") -> DataFrame:
    """The index before numbering: ``first_ts``, ``last_ts`` and ``n_plays``
    of every (user, bucket)."""
    return plays.groupBy(F.col(user_col), _bucket(ts_col, gap).alias("bucket")).agg(
        F.min(F.col(ts_col)).alias("first_ts"),
        F.max(F.col(ts_col)).alias("last_ts"),
        F.count(F.lit(1)).alias("n_plays"),
    )


def number_index(buckets: DataFrame, gap: int, user_col: str = "userid", session_col: str = "session_id") -> DataFrame:
    """``bucket_index`` with whole seconds and session numbers."""
    # whole seconds are a monotone function of the timestamp, so the bucket's
    # first/last second come from its min/max timestamp after aggregating
    idx = (
        buckets.withColumn("first_sec", epoch_seconds("first_ts"))
        .withColumn("last_sec", epoch_seconds("last_ts"))
        .drop("last_ts")
    )
    if gap < SMALL_GAP_SEC:
        return _number_two_level(idx, gap, user_col, session_col)
    w = Window.partitionBy(user_col).orderBy(F.col("bucket").asc())
    prev_last = F.lag("last_sec").over(w)
    opens = F.when(prev_last.isNotNull() & ((F.col("first_sec") - prev_last) > F.lit(gap)), 1).otherwise(0)
    return idx.withColumn(_FLAG, opens).withColumn(
        session_col,
        F.sum(_FLAG).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("long"),
    ).drop(_FLAG)


def _number_two_level(idx: DataFrame, gap: int, user_col: str, session_col: str) -> DataFrame:
    """Session numbers of an index for small gaps, where one user's index can
    have a row per active second: hour-wide ranges of buckets."""
    width = max(gap, 1)
    sb = F.when(F.col("bucket") == F.lit(_NULL_BUCKET), F.lit(_NULL_BUCKET).cast("long")).otherwise(
        F.floor(F.col("bucket") * F.lit(width) / F.lit(SUPER_BUCKET_SEC))
    )
    keyed = idx.withColumn(_SB, sb)
    return _number_in_ranges(keyed, gap, user_col, session_col, "first_sec", "last_sec", F.col("bucket").asc())


def _number_in_ranges(
    keyed: DataFrame, gap: int, user_col: str, session_col: str, first: str, last: str, order: Column
) -> DataFrame:
    """Session numbers of rows dealt to (user, time range ``_SB``): opens and a
    running count are computed inside each range; a per-user window over the
    range summaries (one row per active range) decides whether each range's
    first row opens a session and turns the counts into offsets; the offsets
    join back on (user, range). The rows are shuffled once, on (user, range),
    and no sort holds more than one range of one user. A struct holds the
    user, so that NULL users are equal and the join needs no other key."""
    rows = keyed.withColumn(_IU, F.struct(F.col(user_col)))
    w_in = Window.partitionBy(_IU, _SB).orderBy(order)
    prev_last = F.lag(last).over(w_in)
    local = rows.withColumn(
        _FLAG, F.when(prev_last.isNotNull() & ((F.col(first) - prev_last) > F.lit(gap)), 1).otherwise(0)
    ).withColumn(_CUM, F.sum(_FLAG).over(w_in.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    w_sb = Window.partitionBy(_IU).orderBy(F.col(_SB).asc())
    prev_sb_last = F.lag("sb_last").over(w_sb)
    opens = F.when(prev_sb_last.isNotNull() & ((F.col("sb_first") - prev_sb_last) > F.lit(gap)), 1).otherwise(0)
    before = F.sum(F.col("sb_open") + F.col("sb_opens")).over(w_sb.rowsBetween(Window.unboundedPreceding, -1))
    offsets = (
        local.groupBy(_IU, _SB)
        .agg(F.min(first).alias("sb_first"), F.max(last).alias("sb_last"), F.sum(_FLAG).alias("sb_opens"))
        .withColumn("sb_open", opens)
        .withColumn(_OFF, F.coalesce(before, F.lit(0).cast("long")) + F.col("sb_open"))
        .select(_IU, _SB, _OFF)
    )
    return (
        local.join(offsets, on=[_IU, _SB], how="inner")
        .withColumn(session_col, (F.col(_OFF) + F.col(_CUM)).cast("long"))
        .drop(_IU, _SB, _FLAG, _CUM, _OFF)
    )


def sessions_from_index(
    idx: DataFrame, user_col: str = "userid", session_col: str = "session_id"
) -> DataFrame:
    """One row per session from the index: ``session_start`` (timestamp),
    ``session_duration_sec`` (last - first play start, whole seconds; NULL if
    no timestamp), ``n_plays`` and the session's bucket range
    (``first_bucket``, ``last_bucket``). The index is already partitioned by
    user, so this aggregate adds no shuffle."""
    return idx.groupBy(user_col, session_col).agg(
        F.min("first_ts").alias("session_start"),
        (F.max("last_sec") - F.min("first_sec")).alias("session_duration_sec"),
        F.sum("n_plays").alias("n_plays"),
        F.min("bucket").alias("first_bucket"),
        F.max("bucket").alias("last_bucket"),
    )


def add_session_ids(
    plays: DataFrame,
    session_gap_sec: int = DEFAULT_GAP_SEC,
    user_col: str = "userid",
    ts_col: str = "timestamp",
    session_col: str = "session_id",
    index: DataFrame | None = None,
) -> DataFrame:
    """Every play with its 0-based per-user ``session_id`` (BIGINT).

    The plays are dealt to (user, day-wide time range), numbered inside, and
    get the small per-range offsets by a join on the same key: one shuffle of
    the plays, no join with an index, and a user with a third of the rows is
    sorted day by day. With an ``index`` (``session_index``) the plays join
    its labels on (user, bucket) instead; NULL users match NULL users.
    """
    gap = _check_gap(session_gap_sec)
    if index is not None:
        labels = index.select(F.col(user_col).alias(_IU), F.col("bucket").alias(_IB), session_col)
        keyed = plays.withColumn(_BKT, _bucket(ts_col, gap))
        cond = F.col(user_col).eqNullSafe(F.col(_IU)) & (F.col(_BKT) == F.col(_IB))
        return keyed.join(labels, on=cond, how="inner").drop(_IU, _IB, _BKT)
    width = max(gap, RANGE_SEC)
    keyed = plays.withColumn(_SEC, epoch_seconds(ts_col)).withColumn(
        _SB, F.coalesce(F.floor(F.col(_SEC) / F.lit(width)), F.lit(_NULL_BUCKET).cast("long"))
    )
    order = F.col(ts_col).asc_nulls_first()
    return _number_in_ranges(keyed, gap, user_col, session_col, _SEC, _SEC, order).drop(_SEC)


def session_count(sessions: DataFrame, user_col: str = "userid", session_col: str = "session_id") -> DataFrame:
    """Number of distinct (user, session) pairs; a NULL user counts as a user."""
    return sessions.select(user_col, session_col).distinct().agg(F.count(F.lit(1)).alias("session_count"))


def session_totals(per_session: DataFrame) -> DataFrame:
    """E3 from one row per session with ``n_plays`` (``sessions_from_index``
    or ``compute_session_duration(..., with_play_count=True)``): total plays,
    sessions and plays per session."""
    return per_session.agg(
        F.sum("n_plays").alias("n_plays"),
        F.count(F.lit(1)).alias("n_sessions"),
        F.try_divide(F.sum("n_plays").cast("double"), F.count(F.lit(1))).alias("avg_tracks_per_session"),
    )


def avg_tracks_per_session(
    sessions: DataFrame, user_col: str = "userid", session_col: str = "session_id"
) -> DataFrame:
    """E3 on labelled plays: plays, sessions and plays per session, in one
    two-level aggregate."""
    per = sessions.groupBy(user_col, session_col).agg(F.count(F.lit(1)).alias("n_plays"))
    return session_totals(per)


def compute_session_duration(
    sessions: DataFrame,
    user_col: str = "userid",
    ts_col: str = "timestamp",
    session_col: str = "session_id",
    with_play_count: bool = False,
) -> DataFrame:
    """One row per session with ``session_duration_sec`` = last - first play
    start in whole seconds (0 for a one-play session, NULL if no timestamp)."""
    sec = epoch_seconds(ts_col)
    aggs = [(F.max(sec) - F.min(sec)).alias("session_duration_sec")]
    if with_play_count:
        aggs.append(F.count(F.lit(1)).alias("n_plays"))
    return sessions.groupBy(user_col, session_col).agg(*aggs)


def longest_sessions(
    durations: DataFrame,
    n: int = 10,
    user_col: str = "userid",
    session_col: str = "session_id",
    metric_col: str = "session_duration_sec",
) -> DataFrame:
    """Top ``n`` sessions by ``metric_col`` (ties: user, session id).
    Planned as TakeOrderedAndProject: each task keeps its own top ``n``."""
    return durations.orderBy(
        F.col(metric_col).desc_nulls_last(), F.col(user_col).asc_nulls_first(), F.col(session_col).asc()
    ).limit(int(n))


def _check_top(top_n_sessions: int, top_n_tracks: int, rank_by: str) -> None:
    if int(top_n_sessions) < 1 or int(top_n_tracks) < 1:
        raise ValueError("top_n_sessions and top_n_tracks must be 1 or more")
    if rank_by not in ("duration", "plays"):
        raise ValueError("rank_by must be 'duration' or 'plays'")


def top_tracks_from_sessions(
    sessions: DataFrame,
    top_n_sessions: int = 50,
    top_n_tracks: int = 10,
    rank_by: str = "duration",
    user_col: str = "userid",
    ts_col: str = "timestamp",
    session_col: str = "session_id",
    track_col: str = "track_name",
) -> DataFrame:
    """E8 (``rank_by="duration"``) / E9 (``rank_by="plays"``) on labelled plays.

    Rank all sessions by duration (or by number of plays), keep the top
    ``top_n_sessions`` (ties: user, session id), inner-join their plays and
    return the ``top_n_tracks`` most played ``track_name`` values with
    ``play_count`` (ties: track name). A NULL track is a group; plays of a
    NULL user never match the join. The planner broadcasts the selected
    sessions when they are small. For unlabelled plays,
    ``top_tracks_by_index`` gives the same result without labelling them.
    """
    _check_top(top_n_sessions, top_n_tracks, rank_by)
    per_session = compute_session_duration(sessions, user_col, ts_col, session_col, with_play_count=True)
    top = _rank_sessions(per_session, top_n_sessions, rank_by, user_col, session_col).select(user_col, session_col)
    return (
        sessions.join(top, on=[user_col, session_col], how="inner")
        .groupBy(track_col)
        .agg(F.count(F.lit(1)).alias("play_count"))
        .orderBy(F.col("play_count").desc(), F.col(track_col).asc_nulls_first())
        .limit(int(top_n_tracks))
    )


def top_tracks_from_longest_sessions(sessions: DataFrame, top_n_sessions: int = 50, top_n_tracks: int = 10, **kw):
    """The reference's question - tracks of the sessions with the longest duration."""
    return top_tracks_from_sessions(sessions, top_n_sessions, top_n_tracks, rank_by="duration", **kw)


def top_tracks_from_most_played_sessions(sessions: DataFrame, top_n_sessions: int = 50, top_n_tracks: int = 10, **kw):
    """The prose's question - tracks of the sessions with the most plays."""
    return top_tracks_from_sessions(sessions, top_n_sessions, top_n_tracks, rank_by="plays", **kw)


def _rank_sessions(per_session: DataFrame, n: int, rank_by: str, user_col: str, session_col: str) -> DataFrame:
    order = [F.col("session_duration_sec").desc_nulls_last()]
    if rank_by == "plays":
        order = [F.col("n_plays").desc()] + order
    return per_session.orderBy(*order, F.col(user_col).asc_nulls_first(), F.col(session_col).asc()).limit(int(n))


def top_tracks_by_index(
    plays: DataFrame,
    session_gap_sec: int = DEFAULT_GAP_SEC,
    top_n_sessions: int = 50,
    top_n_tracks: int = 10,
    rank_by: str = "duration",
    user_col: str = "userid",
    ts_col: str = "timestamp",
    session_col: str = "session_id",
    track_col: str = "track_name",
    index: DataFrame | None = None,
) -> DataFrame:
    """E8/E9 without labelling every play: same result as
    ``top_tracks_from_sessions(add_session_ids(plays, gap), ...)``.

    Sessions are ranked from the session index, and the plays are matched with
    the N winners on user and bucket range. The planner broadcasts the winners
    when their measured size allows (any usual N), so that the plays are
    matched inside the scan's tasks and not shuffled. Track counts aggregate
    map-side before their shuffle. A NULL user never matches (as in the
    reference's inner join).
    """
    _check_top(top_n_sessions, top_n_tracks, rank_by)
    gap = _check_gap(session_gap_sec)
    if index is None:
        index = session_index(plays, gap, user_col, ts_col, session_col)
    top = _rank_sessions(sessions_from_index(index, user_col, session_col), top_n_sessions, rank_by, user_col,
                         session_col)
    ranges = top.select(F.col(user_col).alias(_IU), "first_bucket", "last_bucket")
    keyed = plays.select(F.col(user_col), F.col(track_col), _bucket(ts_col, gap).alias(_BKT))
    cond = (
        (F.col(user_col) == F.col(_IU))
        & (F.col(_BKT) >= F.col("first_bucket"))
        & (F.col(_BKT) <= F.col("last_bucket"))
    )
    return (
        keyed.join(ranges, on=cond, how="inner")
        .groupBy(F.col(track_col))
        .agg(F.count(F.lit(1)).alias("play_count"))
        .orderBy(F.col("play_count").desc(), F.col(track_col).asc_nulls_first())
        .limit(int(top_n_tracks))
    )
