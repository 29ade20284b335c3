"""The driver contract of __spark_entry__.py."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import __spark_entry__ as entry
from topiclake.plans.registry import QUERIES

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_oracle_key_is_a_query_and_names_are_plain():
    qs, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(qs)
    assert all(name.isidentifier() and name == name.lower() for name in qs)
    rows_only = {name for name in set(qs) - set(oracle) if name in QUERIES}
    assert rows_only == set()


def test_entry_schema_is_stable(spark):
    a = entry.entry(spark).schema
    b = entry.entry(spark).schema
    assert a == b and [f.name for f in a.fields] == ["topic", "count", "min_key", "max_key"]


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=900, cwd=tmp_path)
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["value"] > 0 and "bronze_count_by_topic" in d["queries"]
