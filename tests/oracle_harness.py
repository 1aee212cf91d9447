"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

Usage: python tests/oracle_harness.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm_value(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(round(v, 6))  # textual: -0.0 and 0.0 differ, as in a value hash
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None) if v.tzinfo else v
    if hasattr(v, "item"):
        return _norm_value(v.item())
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm_value(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df: pd.DataFrame, duck_df: pd.DataFrame) -> str | None:
    if sorted(spark_df.columns) != sorted(duck_df.columns):
        return f"columns differ: {sorted(spark_df.columns)} vs {sorted(duck_df.columns)}"
    if len(spark_df) != len(duck_df):
        return f"row count {len(spark_df)} vs {len(duck_df)}"
    a, b = _rows(spark_df), _rows(duck_df)
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return f"row {i} differs: {x} vs {y}"
    return None


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from playlens.config import local_session
    import __spark_entry__ as entry

    spark = local_session(8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            schema = [(f.name, f.dataType.simpleString()) for f in sdf.schema.fields]
            pdf = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(pdf)} rows ({ts:.1f}s) no oracle")
            continue
        try:
            rel = con.sql(sqls[name])
            dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
            ddf = rel.df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:600]}")
            bad += 1
            continue
        err = compare(pdf, ddf)
        if err:
            bad += 1
            print(f"FAIL {name}: {err}")
        else:
            print(f"OK   {name}: {len(pdf)} rows ({ts:.1f}s) spark={schema} duck={dtypes}")
    print(f"{bad} failures")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
