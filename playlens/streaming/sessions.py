"""Session durations over a growing play log (Structured Streaming).

The batch operators read a finished log. When the log keeps growing (new TSV
files landing in a folder), the same sessions come out of a streaming
aggregation on ``session_window``: Spark keeps one open window per user in
the state store, extends it while plays arrive within the gap, and - in
append mode - emits the session once the watermark has passed its end.
Event time is truncated to whole seconds, and Spark merges windows that
touch, so a gap equal to the limit stays in the session exactly as in
``operators.sessions.add_session_ids``.

State and progress live under a checkpoint location on shared storage, so a
restarted query resumes without losing or repeating sessions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playlens.functions.time import epoch_seconds
from playlens.sources.plays import RAW_PLAYS_SCHEMA


def read_play_stream(
    spark: SparkSession, path: str, quoting: bool = True, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A folder of headerless TSV play logs as a stream (S1 + S2)."""
    reader = spark.readStream.schema(RAW_PLAYS_SCHEMA).option("sep", "\t").option("header", "false")
    if not quoting:
        reader = reader.option("quote", "")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.csv(path).withColumn("timestamp", F.try_to_timestamp(F.col("timestamp")))


def session_durations_stream(
    plays: DataFrame,
    session_gap_sec: int = 20 * 60,
    watermark: str = "1 hour",
    user_col: str = "userid",
    ts_col: str = "timestamp",
) -> DataFrame:
    """E4 as a streaming aggregation: one row per closed session
    ``(userid, session_start, session_end, n_plays, session_duration_sec)``.

    ``session_end`` is the last play's start (whole seconds). Plays with a
    NULL timestamp cannot be placed in event time and are left out.
    """
    gap = int(session_gap_sec)
    if gap <= 0:
        raise ValueError("session_gap_sec must be > 0 for session windows")
    sec_ts = F.date_trunc("second", F.col(ts_col))
    return (
        plays.filter(F.col(ts_col).isNotNull())
        .withColumn("_event_ts", sec_ts)
        .withWatermark("_event_ts", watermark)
        .groupBy(F.col(user_col), F.session_window("_event_ts", f"{gap} seconds").alias("_s"))
        .agg(
            F.count(F.lit(1)).alias("n_plays"),
            F.min("_event_ts").alias("_first"),
            F.max("_event_ts").alias("_last"),
        )
        .select(
            F.col(user_col),
            F.col("_first").cast("timestamp_ntz").alias("session_start"),
            F.col("_last").cast("timestamp_ntz").alias("session_end"),
            "n_plays",
            (epoch_seconds("_last") - epoch_seconds("_first")).alias("session_duration_sec"),
        )
    )


def start_parquet_sink(
    df: DataFrame, output_path: str, checkpoint_location: str, available_now: bool = False
) -> StreamingQuery:
    """Append closed sessions to a Parquet folder; exactly-once through the
    checkpoint (file sink + offsets log)."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint_location)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
