"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SMOKE_DIR


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SMOKE_DIR, BENCH_RUNS="1", BENCH_CPUS="2",
               BENCH_QUERIES="word_count,cell_scan", BENCH_STREAM="0")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    doc = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(doc)
    assert doc["unit"] == "sec" and doc["sf"] == 0.001 and doc["errors"] == {}
    assert set(doc["queries"]) == {"word_count", "cell_scan"}
    assert abs(doc["value"] - sum(doc["queries"].values())) < 1e-3
