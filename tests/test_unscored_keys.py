"""Keys too short to score stay in the forecasts and in the full leaderboard."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from test_selection_and_storage import KEY, T, make_series, noisy  # noqa: E402

from playlens.operators import trees, trend  # noqa: E402

REASON = "fewer train rows than folds"


@pytest.mark.parametrize("options", [{}, {"family": "ridge"}, {"fit_on": "all", "unit_factor": 24.0, "unit_col": "hours"}])
def test_forecast_keeps_unscored_keys(spark, options):
    df = make_series(spark, {"long": noisy(1), "short": [1, 2, 3]})
    rows = trend.best_model_forecast(df, KEY, T, "y", **options).collect()
    assert [(r["month"], r["t"], r["forecast"], r["model"], r["reason"]) for r in rows if r["key"] == "short"] == [
        (None, None, None, None, REASON)
    ]
    scored = [r for r in rows if r["key"] == "long"]
    assert len(scored) == 3 and all(r["forecast"] is not None and r["reason"] is None for r in scored)


def test_full_leaderboard_keeps_unscored_keys(spark):
    df = make_series(spark, {"long": noisy(1), "short": [1, 2, 3]})
    rows = trees.leaderboard_with_trees(df, KEY, T, "y", full_grid=False).collect()
    assert [(r["rank"], r["rmse"], r["reason"]) for r in rows if r["key"] == "short" and r["model"] is None] == [(None, None, REASON)]
    scored = [r for r in rows if r["key"] == "long"]
    assert sorted(r["rank"] for r in scored) == [1, 2, 3, 4, 5] and all(r["reason"] is None for r in scored)
    short = [r["rank"] for r in rows if r["key"] == "short" and r["model"] is not None]
    assert sorted(short) == list(range(1, len(short) + 1))
