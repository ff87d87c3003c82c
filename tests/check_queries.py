"""Run registered queries against their SQL: ``python tests/check_queries.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

import __spark_entry__ as entry  # noqa: E402
from foldmill.session import local_session  # noqa: E402
from oracle import difference  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("check")
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            found = difference(df, oracles[name], sf_dir) if name in oracles else f"rows only: {len(df.collect())}"
        except Exception:
            found = traceback.format_exc(limit=-4)[:1500]
        failed += bool(found) and not found.startswith("rows only")
        print(f"{name:24s} {time.time() - start:6.1f}s {found or 'equal'}", flush=True)
    print("failed:", failed, "queries:", len(queries), "with SQL:", len(oracles))
    return failed


if __name__ == "__main__":
    sys.exit(main())
