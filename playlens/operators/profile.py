"""Profiling aggregations over a plays frame.

Each function is one aggregate plan; map-side partial aggregation keeps the
shuffle to one row per group per task, so hot keys (one artist with a third
of all plays) cost no more than cold ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.functions.stats import numeric_summary, string_summary
from playlens.functions.time import as_wall_clock, calendar_start


def _sql_text(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def row_count(plays: DataFrame) -> DataFrame:
    """Total number of plays."""
    return plays.agg(F.count(F.lit(1)).alias("n_rows"))


def null_report(plays: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL count and percentage for every column, in a single pass.

    Output ``(column, null_count, null_pct)``; the table is aggregated once
    (two expressions per column) and unpivoted.
    """
    cols = list(columns or plays.columns)
    wide = plays.selectExpr(*[f"`{c}` IS NULL AS n{i}" for i, c in enumerate(cols)]).agg(
        F.expr("count(1) AS total"), *[F.expr(f"count_if(n{i}) AS n{i}") for i in range(len(cols))]
    )
    rows = "array(" + ", ".join(
        f"named_struct('column', '{_sql_text(c)}', 'null_count', n{i}, "
        f"'null_pct', round(try_divide(n{i} * 100.0D, total), 6) + 0.0D)"
        for i, c in enumerate(cols)
    ) + ")"
    return wide.selectExpr(f"inline({rows})")


def column_summary(plays: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """D3: ``describe()`` of the string columns (timestamps are skipped)."""
    if columns is None:
        columns = [f.name for f in plays.schema.fields if f.dataType.simpleString() == "string"]
    return string_summary(plays, columns)


def date_range(plays: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """First and last play and the whole days between them (floor of 24 h)."""
    lo, hi = F.min(F.col(ts_col)), F.max(F.col(ts_col))
    return plays.agg(lo.alias("lo"), hi.alias("hi")).select(
        as_wall_clock("lo").alias("min_date"),
        as_wall_clock("hi").alias("max_date"),
        F.floor((F.unix_micros(F.col("hi")) - F.unix_micros(F.col("lo"))) / F.lit(86_400_000_000)).alias(
            "duration_days"
        ),
    )


def activity_by_year(plays: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Plays per calendar year (a NULL year is its own group), ordered."""
    return (
        plays.groupBy(F.year(F.col(ts_col)).alias("year"))
        .agg(F.count(F.lit(1)).alias("track_count"))
        .orderBy(F.col("year").asc_nulls_first())
    )


def activity_by_month(plays: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Plays per calendar month, ordered (the monthly-activity chart table)."""
    return (
        plays.groupBy(calendar_start(ts_col, "month").alias("m"))
        .agg(F.count(F.lit(1)).alias("track_count"))
        .select(as_wall_clock("m").alias("month"), "track_count")
        .orderBy(F.col("month").asc_nulls_first())
    )


def distinct_users(plays: DataFrame, user_col: str = "userid") -> DataFrame:
    """Number of distinct users, a NULL user counting as one."""
    return plays.select(user_col).distinct().agg(F.count(F.lit(1)).alias("n_users"))


def user_activity_stats(plays: DataFrame, user_col: str = "userid") -> DataFrame:
    """Plays per user, then count/mean/stddev/min/max over users."""
    per_user = plays.groupBy(user_col).agg(F.count(F.lit(1)).alias("track_count"))
    return numeric_summary(per_user, "track_count")


def top_artists(plays: DataFrame, n: int = 20, artist_col: str = "artist_name") -> DataFrame:
    """The ``n`` most played artists (ties: name)."""
    return (
        plays.groupBy(artist_col)
        .agg(F.count(F.lit(1)).alias("play_count"))
        .orderBy(F.col("play_count").desc(), F.col(artist_col).asc_nulls_first())
        .limit(int(n))
    )


def top_tracks(
    plays: DataFrame, n: int = 20, track_col: str = "track_name", artist_col: str = "artist_name"
) -> DataFrame:
    """The ``n`` most played (track, artist) pairs (ties: track, artist)."""
    return (
        plays.groupBy(track_col, artist_col)
        .agg(F.count(F.lit(1)).alias("play_count"))
        .orderBy(
            F.col("play_count").desc(), F.col(track_col).asc_nulls_first(), F.col(artist_col).asc_nulls_first()
        )
        .limit(int(n))
    )


def filter_user(plays: DataFrame, userid: str, user_col: str = "userid") -> DataFrame:
    """The plays of one user (an equality filter Catalyst pushes to the scan)."""
    return plays.filter(F.col(user_col) == F.lit(userid))
