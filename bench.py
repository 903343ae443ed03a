"""Benchmark the headline queries.

Runs each query once to warm up, then three timed runs, and reports the best.
A run executes the whole plan into Spark's ``noop`` sink (every row is
produced, nothing is collected).  Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, default the headline set), BENCH_REPEAT (3)
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["panel_point_in_time", "scd2_changed_rows", "panel_current", "snapshot_latest",
            "relative_prices", "validity_intervals", "metadata_as_of", "catalog_health"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from pitpanel.plans.registry import QUERIES
    from pitpanel.session import build_session

    spark = build_session(f"local[{cpus}]", app="pitpanel-bench", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", cpus)),
                          conf={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        best = None
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
        rows[name] = QUERIES[name](spark, sf_dir).count()
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "sum_best_of_%d_query_seconds" % repeat,
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": float(m.group(1)) if m else sf_dir,
        "spark": spark.version, "cores": cpus,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
