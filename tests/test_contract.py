"""The driver contract: bench.py prints one JSON line; __spark_entry__ exposes
entry/queries/oracle_sql with matching keys."""

import json
import os
import subprocess
import sys

import __spark_entry__ as E

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_functions_and_keys():
    assert callable(E.entry)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, "bench.py", "label_join", "status_extract"], cwd=ROOT,
                         env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"label_join", "status_extract"}
    assert d["value"] == round(sum(d["queries"].values()), 3)
