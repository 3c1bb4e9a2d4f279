"""Command line entry point."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_runs_one_query():
    env = {**os.environ, "BENCH_CPUS": "2", "SPARK_DRIVER_MEMORY": "2g"}
    out = subprocess.run([sys.executable, "-m", "sparksignal", "query", "price_frame",
                          "/root/testdata/sf0.001"], cwd=ROOT, env=env, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert int(out.stdout.strip().splitlines()[-1]) > 0
