"""Benchmark: run every registered query over $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with a ``noop`` write (nothing is collected to
the driver).  Prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))

    from pyspark.sql import SparkSession

    from ledgerline.registry import QUERIES
    from ledgerline.session import apply_defaults

    # a local benchmark: its tables go to a fresh scratch warehouse unless one is configured
    warehouse = os.environ.get("BENCH_WAREHOUSE") or tempfile.mkdtemp(prefix="ledgerline-bench-wh-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerline-bench")
        .config("spark.sql.warehouse.dir", warehouse)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus * 2))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)

    names = only or list(QUERIES)
    # warm-up: JIT and file listing, not timed
    QUERIES["snapshot_mtd"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # each query: build + full execution, best of ``repeat`` runs (warm JIT)
    timings, failed = {}, {}
    for name in names:
        best = None
        try:
            for _ in range(repeat):
                t0 = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
            timings[name] = round(best, 3)
        except Exception as e:  # report, keep going
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeat": repeat,
        "spark": spark.version,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
