"""The streaming session operator agrees with the batch sessionizer."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from playlens.config import scratch_path
from playlens.operators.sessions import add_session_ids
from playlens.sources.plays import event_plays, write_raw_tsv
from playlens.streaming.sessions import read_play_stream, session_durations_stream, start_parquet_sink


def test_stream_sessions_equal_batch(spark):
    plays = event_plays(spark, "/root/testdata/sf0.001")
    src = scratch_path(spark, "stream-src")
    # two arrivals: the first and second half of January, then a far-future
    # play of another user that moves the watermark past every open session
    mid = F.lit("2024-01-16").cast("timestamp")
    write_raw_tsv(plays.filter(F.col("timestamp") < mid), f"{src}/part1")
    write_raw_tsv(plays.filter(F.col("timestamp") >= mid), f"{src}/part2")
    flush = spark.createDataFrame(
        [("__flush__", "2030-01-01T00:00:00.000000Z", None, None, "x", "x")],
        "userid string, timestamp string, musicbrainz_artist_id string, artist_name string, "
        "musicbrainz_track_id string, track_name string",
    )
    flush.write.option("sep", "\t").csv(f"{src}/part3")
    files = sorted(
        os.path.join(d, f) for d, _, fs in os.walk(src) for f in fs if f.startswith("part-") and f.endswith(".csv")
    )
    landing = scratch_path(spark, "stream-landing")
    os.makedirs(landing)
    for i, f in enumerate(files):
        os.link(f, os.path.join(landing, f"{i:04d}.tsv"))

    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    stream = session_durations_stream(read_play_stream(spark, landing, max_files_per_trigger=1), 1200, "10 minutes")
    q = start_parquet_sink(stream, out, ckpt)
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(out).filter(F.col("userid") != "__flush__")

    sessions = add_session_ids(plays, 1200)
    want = sessions.groupBy("userid", "session_id").agg(
        F.date_trunc("second", F.min("timestamp")).cast("timestamp_ntz").alias("session_start"),
        F.count(F.lit(1)).alias("n_plays"),
        (F.max(F.col("timestamp").cast("long")) - F.min(F.col("timestamp").cast("long"))).alias(
            "session_duration_sec"
        ),
    ).drop("session_id")
    cols = ["userid", "session_start", "n_plays", "session_duration_sec"]
    assert got.count() == want.count()
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
