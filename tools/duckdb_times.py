"""Time every oracle query in DuckDB (single process, all cores) at one

    python tools/duckdb_times.py /root/testdata/sf0.1
"""

from __future__ import annotations

import json
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from amity.plans import catalog  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

if __name__ == "__main__":
    sf = sys.argv[1].rstrip("/")
    con = duckdb.connect()
    con.execute("SET enable_progress_bar = false")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    times = {}
    for name, sql in catalog.oracle_sql().items():
        best = None
        for _ in range(2):
            t0 = time.perf_counter()
            con.execute(sql).fetchall()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    print(json.dumps({"engine": "duckdb", "sf": sf, "queries": times, "total": round(sum(times.values()), 3)}))
