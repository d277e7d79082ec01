"""bench.py stays runnable and prints one JSON line."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_WARMUP_DIR="/root/testdata/sf0.001",
               BENCH_CPUS="2")
    out = subprocess.run([sys.executable, "bench.py", "recon_suite", "object_manifest"], cwd=ROOT, env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and set(rec["queries"]) == {"recon_suite", "object_manifest"}
    assert rec["value"] == round(sum(rec["queries"].values()), 3) and rec["sf"] == 0.001
