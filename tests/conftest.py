from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from playlens.config import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

PLAYS_DDL = (
    "userid string, timestamp timestamp, musicbrainz_artist_id string, artist_name string, "
    "musicbrainz_track_id string, track_name string"
)


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8)
    yield s


def ts(seconds: float) -> dt.datetime:
    """A timestamp ``seconds`` after 2024-01-01 00:00:00 (session zone is UTC)."""
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


@pytest.fixture
def make_plays(spark):
    def _make(rows):
        """rows: (userid, seconds or None, track_name)"""
        data = [
            (u, None if s is None else ts(s), None, "artist", f"id{i}", t) for i, (u, s, t) in enumerate(rows)
        ]
        return spark.createDataFrame(data, PLAYS_DDL)

    return _make
