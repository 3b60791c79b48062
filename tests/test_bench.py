import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="loan_gold,merge_update")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    result = json.loads(out[-1])
    assert result["unit"] == "sec" and result["sf"] == 0.001 and "errors" not in result
    assert set(result["queries"]) == {"loan_gold", "merge_update"} and result["value"] > 0
