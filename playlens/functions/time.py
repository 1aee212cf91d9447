"""Column helpers for time: epoch seconds, calendar parts, unit conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_MINUTE = 60
SECONDS_PER_HOUR = 3600
SECONDS_PER_DAY = 86400

CALENDAR_GRAINS = ("year", "month", "week", "day")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts: str | Column) -> Column:
    """Whole epoch seconds of a timestamp.

    Fractional seconds are dropped before any subtraction, as the reference's
    ``cast("long")`` does; the cast floors, so pre-1970 values stay monotone.
    Works for both TIMESTAMP and TIMESTAMP_NTZ inputs (NTZ is read in the
    session time zone).
    """
    return _col(ts).cast("timestamp").cast("long")


def calendar_start(ts: str | Column, grain: str = "month") -> Column:
    """Start of the year/month/week/day containing ``ts`` (P4), as TIMESTAMP."""
    if grain not in CALENDAR_GRAINS:
        raise ValueError(f"grain must be one of {CALENDAR_GRAINS}, got {grain!r}")
    return F.date_trunc(grain, _col(ts).cast("timestamp"))


def as_wall_clock(ts: str | Column) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ for output columns (same wall-clock value)."""
    return _col(ts).cast("timestamp_ntz")


def seconds_to(value: str | Column, unit: str) -> Column:
    """Convert seconds to minutes/hours/days as DOUBLE (P5)."""
    div = {"seconds": 1, "minutes": SECONDS_PER_MINUTE, "hours": SECONDS_PER_HOUR,
           "days": SECONDS_PER_DAY}[unit]
    return _col(value).cast("double") / F.lit(float(div))
