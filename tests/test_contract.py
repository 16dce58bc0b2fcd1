"""Driver contract: bench.py prints one JSON line with the required keys."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry
from adevents.plans import catalog

ROOT = Path(__file__).resolve().parents[1]


def test_entry_module_contract():
    assert callable(entry.entry)
    q, o = entry.queries(), entry.oracle_sql()
    assert q and set(o) <= set(q) and set(catalog.queries()) <= set(o)
    assert all(callable(f) for f in q.values()) and all(isinstance(s, str) and s.strip() for s in o.values())


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1")
    proc = subprocess.run([sys.executable, str(ROOT / "bench.py")], capture_output=True, text=True, env=env, timeout=900)
    assert proc.returncode == 0, proc.stderr[-3000:]
    lines = [line for line in proc.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out)
    assert out["unit"] == "sec" and out["value"] > 0 and out["sf"] == 0.001
    assert all(f"q{i}_rollup" in out["queries"] for i in range(1, 6))
