"""A stored session index that grows by batches of plays (E1/E4 by append).

The session index before numbering - first and last time and play count per
(user, gap-wide bucket) - is a mergeable aggregate: the index of two sets of
plays is the two indexes put together and aggregated again. So a day of plays
is added by writing its own small index; no earlier play is read, and plays
may come late or in any order. Sessions are numbered when the store is read,
by a window over the buckets.

A batch is written under its name and replaces what was stored under that
name, so a repeated or retried batch counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.operators.sessions import _check_gap, bucket_index, number_index


def append_plays(
    plays: DataFrame, path: str, batch: str, session_gap_sec: int, user_col: str = "userid", ts_col: str = "timestamp"
) -> None:
    """Store the index of one batch of plays under ``path``."""
    gap = _check_gap(session_gap_sec)
    index = bucket_index(plays, gap, user_col, ts_col)
    index.write.mode("overwrite").parquet(f"{path.rstrip('/')}/gap={gap}/batch={batch}")


def stored_index(
    spark: SparkSession, path: str, session_gap_sec: int, user_col: str = "userid", session_col: str = "session_id"
) -> DataFrame:
    """The session index of all batches stored for this gap, as
    ``sessions.session_index`` gives it for all their plays at once."""
    gap = _check_gap(session_gap_sec)
    parts = spark.read.parquet(f"{path.rstrip('/')}/gap={gap}")
    merged = parts.groupBy(user_col, "bucket").agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n_plays").alias("n_plays")
    )
    return number_index(merged, gap, user_col, session_col)
