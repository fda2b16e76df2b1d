import json
import os
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry_module
from clickpulse.registry.oracles import ORACLES
from clickpulse.registry.queries import QUERIES

REPO = Path(__file__).resolve().parent.parent


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns[0] == "area_level"
    assert result.count() > 0


def test_registries():
    assert QUERIES.keys() == ORACLES.keys()
    named, sql = entry_module.queries().keys(), entry_module.oracle_sql().keys()
    assert QUERIES.keys() <= sql <= named
    # What has no SQL belongs to the training-data operators.
    assert all(name == "pipeline" or name.startswith("op") for name in named - sql)


def test_bench():
    env = os.environ | {"BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "4"}
    command = [sys.executable, "bench.py", "session_totals", "ad_clicks_parsed"]
    run = subprocess.run(command, cwd=REPO, env=env, capture_output=True, text=True, check=True)
    result = json.loads(run.stdout.strip())
    assert list(result["queries"]) == command[2:]
    assert result["value"] == round(sum(result["queries"].values()), 3)
    assert (result["unit"], result["sf"]) == ("sec", "0.001")
