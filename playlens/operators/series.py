"""User series (U1-U6): sessions per user, the top user, monthly averages.

Every function works for all users (or all series keys) at once; the
reference's single-user pipeline is the special case ``key = top user``.
The month counter is a window partitioned by the key, never a global window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.functions.time import as_wall_clock, calendar_start, epoch_seconds


def sessions_per_user(sessions: DataFrame, user_col: str = "userid", session_col: str = "session_id") -> DataFrame:
    """U1 (table): number of distinct sessions per user (``n_sessions``)."""
    return (
        sessions.select(user_col, session_col)
        .distinct()
        .groupBy(user_col)
        .agg(F.count(F.lit(1)).alias("n_sessions"))
    )


def top_user(sessions: DataFrame, user_col: str = "userid", session_col: str = "session_id") -> DataFrame:
    """U1 (top-1): the user with most sessions (ties: smallest user id).
    An empty input gives an empty frame instead of failing."""
    return (
        sessions_per_user(sessions, user_col, session_col)
        .orderBy(F.col("n_sessions").desc(), F.col(user_col).asc_nulls_first())
        .limit(1)
    )


def user_sessions(
    sessions: DataFrame,
    userid: str | None = None,
    user_col: str = "userid",
    ts_col: str = "timestamp",
    session_col: str = "session_id",
) -> DataFrame:
    """One row per session: ``session_start`` and ``session_duration_sec``.
    ``userid=None`` keeps every user; a value filters first (pushed to the scan)."""
    if userid is not None:
        sessions = sessions.filter(F.col(user_col) == F.lit(userid))
    sec = epoch_seconds(ts_col)
    return sessions.groupBy(user_col, session_col).agg(
        F.min(F.col(ts_col)).alias("session_start"),
        (F.max(sec) - F.min(sec)).alias("session_duration_sec"),
    )


def user_sessions_from_index(
    index: DataFrame, userid: str | None = None, user_col: str = "userid", session_col: str = "session_id"
) -> DataFrame:
    """U2 from a session index (``sessions.session_index``): the same rows as
    ``user_sessions`` without revisiting the plays."""
    from playlens.operators.sessions import sessions_from_index

    if userid is not None:
        index = index.filter(F.col(user_col) == F.lit(userid))
    return sessions_from_index(index, user_col, session_col).select(
        user_col, session_col, "session_start", "session_duration_sec"
    )


def monthly_session_duration(
    user_sessions_df: DataFrame,
    key_cols: list[str] | tuple[str, ...] = ("userid",),
    value_col: str = "session_duration_sec",
    out_col: str = "avg_session_duration_sec",
    scale: float = 1.0,
) -> DataFrame:
    """Per key and month of the session *start*, the mean duration.
    ``scale`` divides the mean (e.g. 86400 for days)."""
    avg = F.avg(F.col(value_col))
    if scale != 1.0:
        avg = avg / F.lit(float(scale))
    return (
        user_sessions_df.groupBy(*key_cols, calendar_start("session_start", "month").alias("m"))
        .agg(avg.alias(out_col))
        .select(*key_cols, as_wall_clock("m").alias("timestamp_month"), out_col)
    )


def add_month_counter(
    monthly: DataFrame,
    key_cols: list[str] | tuple[str, ...] = ("userid",),
    month_col: str = "timestamp_month",
    out_col: str = "count_months",
) -> DataFrame:
    """U4: 0, 1, 2, ... over the months present for each key (gaps not filled).
    Rows without a month (sessions without a time) are not counted and not
    returned: they belong to no place in the series."""
    w = Window.partitionBy(*key_cols).orderBy(F.col(month_col).asc())
    return monthly.filter(F.col(month_col).isNotNull()).withColumn(out_col, (F.row_number().over(w) - 1).cast("int"))


def fill_calendar(
    monthly: DataFrame,
    key_cols: list[str] | tuple[str, ...] = ("userid",),
    month_col: str = "timestamp_month",
    value_col: str = "avg_session_duration_sec",
    fill: str = "previous",
    out_col: str = "count_months",
) -> DataFrame:
    """The series on a regular calendar: every month from a key's first to its
    last, counted from 0, so that lag 12 is a year. ``fill`` gives a missing
    month (and a month with a NULL value) NULL (``"null"``), 0 (``"zero"``),
    the value before it (``"previous"``) or the line between its neighbours
    (``"linear"``); ``filled`` marks them. One row per key and month is
    expected; rows without a month are left out. NULL keys are a key."""
    if fill not in ("null", "zero", "previous", "linear"):
        raise ValueError("fill must be 'null', 'zero', 'previous' or 'linear'")
    present = monthly.filter(F.col(month_col).isNotNull())
    # Each row brings the months up to the next one: no spine to join with.
    w = Window.partitionBy(*key_cols).orderBy(F.col(month_col).asc())
    following = F.lead(F.col(month_col)).over(w)
    until = F.coalesce(F.add_months(following, -1), F.col(month_col).cast("date"))
    months = F.sequence(F.col(month_col).cast("date"), until, F.expr("interval 1 month"))
    spans = present.select(*key_cols, F.col(value_col), months.alias("_months"))
    rows = spans.select(*key_cols, F.col(value_col), F.posexplode("_months").alias("_at", "_month"))
    kind = monthly.schema[month_col].dataType
    rows = rows.select(
        *key_cols,
        F.col("_month").cast(kind).alias(month_col),
        F.when(F.col("_at") == 0, F.col(value_col)).alias("_own"),
    ).withColumn(out_col, (F.row_number().over(w) - 1).cast("int"))
    before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    own, t = F.col("_own"), F.col(out_col)
    last = F.last(own, True).over(before)
    if fill == "linear":
        at = F.when(own.isNotNull(), t)
        t0, t1 = F.last(at, True).over(before), F.first(at, True).over(after)
        line = last + (F.first(own, True).over(after) - last) * F.try_divide(t - t0, t1 - t0)
        value = F.coalesce(own, line)
    else:
        value = {"null": own, "zero": F.coalesce(own, F.lit(0.0)), "previous": last}[fill]
    return rows.select(*key_cols, month_col, out_col, value.alias(value_col), own.isNull().alias("filled"))


def top_user_monthly_series(
    sessions: DataFrame,
    user_col: str = "userid",
    ts_col: str = "timestamp",
    session_col: str = "session_id",
    per_session: DataFrame | None = None,
) -> DataFrame:
    """U1 -> U2 -> U3 -> U4 for the top user, kept lazy.

    The top user is a one-row frame joined as a broadcast semi join (one row:
    a fixed size), so nothing is collected to the driver. ``sessions`` may be
    sessionized plays or a session index; ``per_session`` (U2 rows) skips
    recomputing the sessions from plays.
    """
    top = top_user(sessions, user_col, session_col).select(user_col)
    if per_session is None:
        per_session = user_sessions(sessions, None, user_col, ts_col, session_col)
    us = per_session.join(
        F.broadcast(top), on=user_col, how="left_semi"
    )
    monthly = monthly_session_duration(us, (user_col,))
    return add_month_counter(monthly, (user_col,)).select(
        user_col, "timestamp_month", "count_months", "avg_session_duration_sec"
    )


def user_with_longest_session(
    sessions: DataFrame | None,
    user_col: str = "userid",
    ts_col: str = "timestamp",
    session_col: str = "session_id",
    per_session: DataFrame | None = None,
) -> DataFrame:
    """The user whose single longest session is longest
    (ties: larger total session time, then smallest user id).
    ``per_session`` (U2 rows) may replace ``sessions``."""
    if per_session is None:
        per_session = user_sessions(sessions, None, user_col, ts_col, session_col)
    per_user = (
        per_session
        .groupBy(user_col)
        .agg(
            F.max("session_duration_sec").alias("longest_session_sec"),
            F.sum("session_duration_sec").alias("total_session_sec"),
            F.count(F.lit(1)).alias("n_sessions"),
        )
    )
    return per_user.orderBy(
        F.col("longest_session_sec").desc_nulls_last(),
        F.col("total_session_sec").desc_nulls_last(),
        F.col(user_col).asc_nulls_first(),
    ).limit(1)
