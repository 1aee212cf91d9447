"""Count scans, shuffles and reused shuffles in each query's executed plan.

Usage: python tests/plan_audit.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def audit(df) -> dict:
    df.collect()  # executes this DataFrame's own plan, so AQE's final plan is shown
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]  # AQE prints both; count the executed one
    return {
        "scans": len(re.findall(r"FileScan|Scan parquet|Scan csv|Scan ExistingRDD", plan)),
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "reused": plan.count("ReusedExchange"),
        "single_partition": plan.count("SinglePartition"),
    }


def main(argv):
    sf = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from playlens.config import local_session
    import __spark_entry__ as entry

    spark = local_session(8)
    qs = entry.queries()
    for n in names or list(qs):
        print("AUDIT", n, audit(qs[n](spark, sf)))


if __name__ == "__main__":
    main(sys.argv)
