"""Small helpers: the oracle SQL rewrite and the shared-folder materialization."""

from __future__ import annotations

import duckdb

from playlens.config import materialize
from playlens.plans.oracle import fold_negative_zero


def test_fold_negative_zero_wraps_every_round_call():
    sql = "SELECT round(a, 6) AS x, round(sqrt(round(b, 2)), 6) y, around(c) FROM t ORDER BY round(r, 6)"
    out = fold_negative_zero(sql)
    assert out == (
        "SELECT (round(a, 6) + 0.0) AS x, (round(sqrt((round(b, 2) + 0.0)), 6) + 0.0) y, around(c) "
        "FROM t ORDER BY (round(r, 6) + 0.0)"
    )
    v = duckdb.sql(fold_negative_zero("SELECT round(CAST(-0.0000001 AS DOUBLE), 6) AS z")).fetchall()[0][0]
    assert str(v) == "0.0"


def test_materialize_writes_under_checkpoint_dir(spark):
    df = spark.range(5).withColumnRenamed("id", "v")
    out = materialize(df, "helper-test")
    root = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    paths = out.inputFiles()
    assert paths and all(root.replace("file:", "") in p for p in paths)
    assert sorted(r["v"] for r in out.collect()) == [0, 1, 2, 3, 4]
