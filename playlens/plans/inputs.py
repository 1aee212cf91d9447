"""Inputs of the registered queries, derived by Spark from the driver tables
(FIXTURES.md): event plays, order plays, their sessions, the keyed series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.config import materialize as materialize_df
from playlens.functions.time import as_wall_clock, calendar_start
from playlens.operators.series import add_month_counter, user_sessions_from_index
from playlens.operators.sessions import add_session_ids, session_index
from playlens.sources.plays import event_plays, order_plays, table

EVENT_GAP = 20 * 60  # the reference's default: 20 minutes
EVENT_GAP_LONG = 6 * 3600  # more multi-play sessions on the synthetic events
ORDER_GAP = 90 * 86400  # orders are days apart: a 90-day gap
SERIES_KEY = "series_key"
SERIES_Y = "avg_session_duration_days"


def event_sessions(spark: SparkSession, sf_dir: str, gap: int = EVENT_GAP) -> DataFrame:
    return add_session_ids(event_plays(spark, sf_dir), gap)


def order_sessions(spark: SparkSession, sf_dir: str, gap: int = ORDER_GAP) -> DataFrame:
    return add_session_ids(order_plays(spark, sf_dir), gap)


def event_index(spark: SparkSession, sf_dir: str, gap: int = EVENT_GAP) -> DataFrame:
    return session_index(event_plays(spark, sf_dir), gap)


def order_index(spark: SparkSession, sf_dir: str, gap: int = ORDER_GAP) -> DataFrame:
    return session_index(order_plays(spark, sf_dir), gap)


def keyed_series(spark: SparkSession, sf_dir: str, gap: int = ORDER_GAP, materialize: bool = False) -> DataFrame:
    """Monthly mean session duration (days) per customer market segment.

    Sessions come from the session index (no per-order sort) and are summed
    per (user, month) before the customer join, so the join moves one row
    per user and month, not per order or session; the customer side is a
    dimension that grows with the data, so Spark (AQE) chooses the join
    strategy from measured sizes.

    ``materialize=True`` writes the series (keys x months rows - small next
    to the plays it summarises) once to the shared checkpoint folder and
    returns a frame reading it: model pipelines consume the series in many
    branches, and without the cut each branch would re-read and re-sessionize
    the whole order history. The checkpoint also survives executor loss.
    """
    us = user_sessions_from_index(order_index(spark, sf_dir, gap))
    # pre-aggregate to (user, month) before the customer join: a heavy user
    # then brings one row per month to the join, not one per session; the
    # mean stays exact (total seconds / sessions)
    per_user_month = us.groupBy("userid", calendar_start("session_start", "month").alias("m")).agg(
        F.sum("session_duration_sec").alias("total_sec"), F.count("session_duration_sec").alias("n")
    )
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("userid"), F.col("c_mktsegment").alias(SERIES_KEY)
    )
    monthly = (
        per_user_month.join(cust, on="userid", how="inner")
        .groupBy(SERIES_KEY, "m")
        .agg((F.try_divide(F.sum("total_sec").cast("double"), F.sum("n")) / F.lit(86400.0)).alias(SERIES_Y))
        .select(SERIES_KEY, as_wall_clock("m").alias("timestamp_month"), SERIES_Y)
    )
    series = add_month_counter(monthly, (SERIES_KEY,))
    if materialize:
        series = materialize_df(series, "keyed_series")
    return series
