import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEAT="1",
               BENCH_WARM_DIR="", BENCH_ONLY="arbitrage,upsert", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and set(d["queries"]) == {"arbitrage", "upsert"} and d["sf"] == 0.001
    assert d["value"] == round(sum(d["queries"].values()), 3) or abs(d["value"] - sum(d["queries"].values())) < 0.01
