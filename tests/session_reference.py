"""The definition of sessions as one window per user, to test plans against."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def session_ids_by_definition(plays: DataFrame, gap: int, user_col: str = "userid", ts_col: str = "timestamp") -> DataFrame:
    by_time = Window.partitionBy(user_col).orderBy(F.col(ts_col).asc_nulls_first())
    second = F.floor(F.unix_micros(ts_col) / 1_000_000)
    opened = (second - F.lag(second).over(by_time) > gap).cast("int")
    marked = plays.withColumn("_opened", F.coalesce(opened, F.lit(0)))
    running = F.sum("_opened").over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return marked.withColumn("session_id", running.cast("long")).drop("_opened")
