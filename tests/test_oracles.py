"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

from __future__ import annotations

import pytest

from oracle_harness import compare, duck
from playlens.plans import catalog

SF = "/root/testdata/sf0.01"
QUERIES = catalog.queries()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = con.sql(SQL[name]).df()
    err = compare(got, want)
    assert err is None, err


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_oracle_runs(spark, name):
    """Models without SQL: every key is scored, errors are not negative, and
    predictions stay near the range of the target."""
    rows = QUERIES[name](spark, SF).toPandas()
    assert len(rows) and not rows.isnull().all(axis=None)
    if "rmse" in rows:
        assert (rows["rmse"] >= 0).all() and (rows["r2"] <= 1).all()
        assert rows.groupby("series_key").size().min() >= 1 and rows["series_key"].nunique() == 5
    if "prediction" in rows:
        low, high = rows["avg_session_duration_days"].min(), rows["avg_session_duration_days"].max()
        assert rows["prediction"].between(low - (high - low), high + (high - low)).all()
