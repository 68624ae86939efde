"""bench.py prints one JSON line in the shape the driver records."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_QUERIES="snapshot_mtd,deposit_totals",
               BENCH_REPEAT="1", BENCH_CPUS="2", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"snapshot_mtd", "deposit_totals"}
    assert d["value"] == round(sum(d["queries"].values()), 3) or abs(d["value"] - sum(d["queries"].values())) < 0.01
    assert "failed" not in d
