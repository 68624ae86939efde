"""
and shuffle bytes (from Spark's event log in a scratch folder), plus two
design comparisons: snapshot_union incremental vs rebuild, and the one-scan
movement expansion (D9, D11) vs one scan and one distinct per arm.

usage: python tools/measure.py [SF_DIR] [OUT.json]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out_path = sys.argv[2] if len(sys.argv) > 2 else None
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    log_dir = tempfile.mkdtemp(prefix="ledgerline-eventlog-")

    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from ledgerline.operators.movements import expand_movements
    from ledgerline.plans import services as S
    from ledgerline.registry import MONTH_CLOSE, QUERIES
    from ledgerline.session import apply_defaults
    from ledgerline.sources import fixtures as fx
    from ledgerline.sources.snapshot import snapshot_union

    memory = os.environ.get("BENCH_DRIVER_MEMORY", "16g")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("ledgerline-measure")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", str(cpus * 2))
             .config("spark.driver.memory", memory)
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    sc = spark.sparkContext

    def timed(group: str, build):
        sc.setJobGroup(group, group)
        t0 = time.perf_counter()
        df = build()
        df.write.format("noop").mode("overwrite").save()
        dt = time.perf_counter() - t0
        sc.setJobGroup(f"count:{group}", "row count")
        rows = df.count()
        return round(dt, 3), rows

    results = {}
    timed("warmup", lambda: QUERIES["snapshot_mtd"](spark, sf_dir))
    for name, fn in QUERIES.items():
        secs, rows = timed(name, lambda fn=fn: fn(spark, sf_dir))
        results[name] = {"seconds": secs, "rows": rows}

    # snapshot_union: incremental (one snapshot) vs rebuild (all closes, one scan)
    snap = lambda: fx.fx_snapshot(spark, sf_dir)
    for mode in ("incremental", "rebuild"):
        secs, rows = timed(f"snapshot_union:{mode}",
                           lambda mode=mode: snapshot_union(snap(), "event_ts", MONTH_CLOSE, mode=mode).select("id", "price").distinct())
        results[f"snapshot_union:{mode}"] = {"seconds": secs, "rows": rows}

    # One scan + one distinct vs one scan + one distinct per arm
    orig = expand_movements

    def arm_by_arm(df, arms, columns, types=None, distinct=True):
        parts = [orig(df, [a], columns, types, distinct) for a in arms]
        return reduce(lambda a, b: a.unionByName(b), parts)

    for label, build in (("movements_other", S.other_movements), ("movements_aftersales", S.aftersales_movements)):
        secs, rows = timed(f"{label}:one_scan", lambda build=build: build(fx.fx_detail(spark, sf_dir), MONTH_CLOSE))
        results[f"{label}:one_scan"] = {"seconds": secs, "rows": rows}
        S.expand_movements = arm_by_arm
        try:
            secs, rows = timed(f"{label}:arm_by_arm", lambda build=build: build(fx.fx_detail(spark, sf_dir), MONTH_CLOSE))
        finally:
            S.expand_movements = orig
        results[f"{label}:arm_by_arm"] = {"seconds": secs, "rows": rows}

    version = spark.version
    spark.stop()

    # shuffle bytes and stage counts per job group, from the event log
    stage_group, shuffle, read, stages = {}, defaultdict(int), defaultdict(int), defaultdict(set)
    paths = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p))
    for path in paths:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    shuffle[group] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    read[group] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
                    stages[group].add(ev.get("Stage ID"))
    for name, r in results.items():
        r["shuffle_bytes"] = shuffle.get(name, 0)
        r["input_bytes"] = read.get(name, 0)
        r["stages"] = len(stages.get(name, ()))
    out = {"sf_dir": sf_dir, "cores": cpus, "driver_memory": memory, "spark": version, "queries": results}
    text = json.dumps(out, indent=1)
    if out_path:
        open(out_path, "w").write(text)
    print(text)


if __name__ == "__main__":
    main()
