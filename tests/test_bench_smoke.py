"""bench.py runs end to end and prints one JSON line (the driver's per-round bench)."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(tmp_path):
    env = dict(
        os.environ,
        BENCH_SF_DIR="/root/testdata/sf0.001",
        BENCH_CPUS="2",
        BENCH_REPEAT="1",
        BENCH_WARMUP="0",
        SPARK_LOCAL_DIRS=str(tmp_path),
    )
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")],
        env=env,
        capture_output=True,
        text=True,
        timeout=600,
        check=True,
    ).stdout.strip().splitlines()
    assert len(out) == 1
    result = json.loads(out[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert result["value"] > 0 and "top_words" in result["queries"] and "files_top_words_report" in result["queries"]
