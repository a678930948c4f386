"""bench.py prints one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEATS="1",
               BENCH_QUERIES="facility_mart,global_rank_orders", CITYLAKE_TMP=str(tmp_path))
    proc = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], capture_output=True, text=True,
                          timeout=600, env=env, cwd=str(tmp_path))
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [ln for ln in proc.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == 0.001 and set(out["queries"]) == {"facility_mart", "global_rank_orders"}
    assert out["value"] == round(sum(out["queries"].values()), 3) and "errors" not in out
