"""bench.py prints exactly one JSON line with the driver's keys."""

import json
import os
import subprocess
import sys

from conftest import SMOKE_DIR

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SMOKE_DIR, BENCH_CPUS="2",
               BENCH_QUERIES="silver_subscription_plans,gold_as_of_date")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"silver_subscription_plans", "gold_as_of_date"}
    assert all(isinstance(v, float) for v in d["queries"].values())
