"""Chart tables (V1, V2): the data behind the reference's plots, in long form.
Drawing is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def observed_and_forecast(
    series: DataFrame,
    forecast: DataFrame,
    key_cols: list[str],
    month_col: str,
    y_col: str,
    forecast_col: str,
) -> DataFrame:
    """V1: both series on one time axis: ``(keys, month, value, series)`` with
    ``series`` in {observed, forecast}."""
    obs = series.select(
        *key_cols, F.col(month_col).alias("month"), F.col(y_col).cast("double").alias("value"),
        F.lit("observed").alias("series"),
    )
    fc = forecast.select(
        *key_cols, F.col("month"), F.col(forecast_col).cast("double").alias("value"), F.lit("forecast").alias("series")
    )
    return obs.unionByName(fc)


def model_comparison(board: DataFrame, key_cols: list[str]) -> DataFrame:
    """V2: the leaderboard unpivoted to ``(keys, model, metric, value)``,
    metric in {rmse, r2}."""
    return board.filter(F.col("model").isNotNull()).select(*key_cols, "model", "rmse", "r2").unpivot(
        [*key_cols, "model"], ["rmse", "r2"], "metric", "value"
    )
