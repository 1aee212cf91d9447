"""TSV scan (quoting, short rows, bad timestamps), sinks, and the driver entry."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from playlens.config import scratch_path
from playlens.sources import sinks
from playlens.sources.plays import RAW_PLAYS_SCHEMA, good_plays, load_track_data, read_raw_tsv, scan_lines, write_raw_tsv

LINES = [
    "u1\t2009-05-04T23:08:57Z\tart1\tArtist\ttr1\t\"Heroes\"",
    "u1\t2009-05-04T23:30:00Z\tart1\tArtist\ttr2\tSong \"x\" y",
    "u2\tbad\t\tNoId\ttr3\tPlain",
    "u3\t2009-05-05T00:00:00Z\tonly",
]


def _tsv() -> str:
    d = tempfile.mkdtemp(prefix="playlens-test-")
    p = os.path.join(d, "plays.tsv")
    with open(p, "w") as f:
        f.write("\n".join(LINES) + "\n")
    return p


def test_tsv_scan_default_quoting_and_nulls(spark):
    df = load_track_data(spark, _tsv())
    assert [f.name for f in df.schema.fields] == [f.name for f in RAW_PLAYS_SCHEMA.fields]
    rows = {r["musicbrainz_track_id"]: r for r in df.collect()}
    assert rows["tr1"]["track_name"] == "Heroes"  # default quoting strips the quotes
    assert rows["tr1"]["timestamp"] == dt.datetime(2009, 5, 4, 23, 8, 57)
    assert rows["tr3"]["timestamp"] is None  # unparsable -> NULL, no failure
    assert rows["tr3"]["musicbrainz_artist_id"] is None  # empty field -> NULL
    short = [r for r in df.collect() if r["userid"] == "u3"][0]
    assert short["artist_name"] is None and short["track_name"] is None  # short row padded


def test_tsv_scan_without_quoting_keeps_text(spark):
    df = read_raw_tsv(spark, _tsv(), quoting=False)
    names = {r["musicbrainz_track_id"]: r["track_name"] for r in df.collect()}
    assert names["tr1"] == '"Heroes"' and names["tr2"] == 'Song "x" y'


def test_tsv_round_trip(spark):
    df = load_track_data(spark, _tsv())
    out = scratch_path(spark, "roundtrip")
    write_raw_tsv(df, out)
    back = load_track_data(spark, out)
    key = ["userid", "musicbrainz_track_id", "timestamp", "track_name"]
    assert back.select(*key).exceptAll(df.select(*key)).count() == 0
    assert df.select(*key).exceptAll(back.select(*key)).count() == 0


def test_result_sink_and_preview(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("track_name"), (F.col("id") % 7).alias("play_count"))
    out = scratch_path(spark, "sink")
    sinks.write_tsv(df, out, single_file=True)
    back = sinks.read_tsv(spark, out, "track_name string, play_count bigint")
    assert back.count() == 30 and len([f for f in os.listdir(out) if f.startswith("part-")]) == 1
    head = [r["track_name"] for r in sinks.preview(df, ["track_name"], 3).collect()]
    tail = [r["track_name"] for r in sinks.preview(df, ["track_name"], 3, tail=True).collect()]
    assert head == ["0", "1", "10"] and tail == ["9", "8", "7"]


def test_scratch_path_uses_session_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(root.rstrip("/"))


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    rows = df.collect()
    assert [f.name for f in df.schema.fields] == ["track_name", "play_count"]
    assert 0 < len(rows) <= 10
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_good_and_rejected_lines_are_the_file(spark):
    """Every line is kept with its text: blank and white lines, too few and too
    many fields, bad and missing timestamps."""
    lines = [*LINES, "", "  ", "u4\t\ta\tb\tc\td", "u5\t2009-05-05T00:00:00Z\ta\tb\tc\td\textra"]
    path = os.path.join(tempfile.mkdtemp(prefix="playlens-test-"), "plays.tsv")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    scanned = scan_lines(spark, path)
    rows = scanned.collect()
    assert sorted(r["line"] for r in rows) == sorted(lines)
    reasons = {r["line"]: r["reason"] for r in rows}
    assert [reasons[x] for x in lines] == [None, None, "timestamp", "fields", "blank", "blank", None, "fields"]
    good = {r["musicbrainz_track_id"]: r["track_name"] for r in good_plays(scanned).collect()}
    assert good == {"tr1": "Heroes", "tr2": 'Song "x" y', "c": "d"}
    verbatim = good_plays(scan_lines(spark, path, quoting=False)).where("musicbrainz_track_id = 'tr1'").first()
    assert verbatim["track_name"] == '"Heroes"'
    out = scratch_path(spark, "rejected-test")
    sinks.write_rejected(scanned, out)
    assert sinks.read_rejected(spark, out).count() + good_plays(scanned).count() == len(lines)


def test_rejects_of_an_empty_log(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="playlens-test-"), "plays.tsv")
    open(path, "w").close()
    assert scan_lines(spark, path).count() == 0
