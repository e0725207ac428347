"""bench.py prints one JSON line with the driver's fields."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="4",
               BENCH_QUERIES="high_risk_transactions,cdc_current_state")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True)
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["metric"] and rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"high_risk_transactions", "cdc_current_state"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 1e-6
