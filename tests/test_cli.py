"""python -m ledgerline runs a daily job end to end (separate process)."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cost_job_from_the_command_line(tmp_path):
    env = dict(os.environ, PYTHONPATH=ROOT)
    extract = tmp_path / "extract"
    cmd = [sys.executable, "-m", "ledgerline", "cost", "--as-of", "1998-03-02", "--fixtures", "/root/testdata/sf0.001",
           "--prefix", "cli_", "--extract", str(extract)]
    out = subprocess.run(cmd, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    assert any(f.endswith(".csv") for f in os.listdir(extract))
    wh = tmp_path / "spark-warehouse"
    if wh.exists():  # default warehouse location (unless the environment configures another)
        assert sorted(os.listdir(wh)) == ["cli_dwd_cost_detail.versions", "cli_dwd_deposits", "cli_dws_daily_profit.versions"]
