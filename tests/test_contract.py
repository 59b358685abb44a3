"""Driver contract: registry/oracle key sets, bench output shape."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import __spark_entry__ as E

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_key_has_an_oracle_and_back():
    from contrail.catalog import QUERIES
    from oracle_sql import ORACLE
    assert set(QUERIES) == set(ORACLE)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_oracle_sql_uses_only_driver_tables():
    import duckdb
    from oracle_harness import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    for key, sql in E.oracle_sql().items():
        con.execute(f"EXPLAIN {sql}")  # binds: every referenced table is a driver view or a CTE


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_REPEAT="1",
               BENCH_KEYS="dash_kpi", BENCH_CPUS="2")
    r = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True,
                       text=True, timeout=600, env=env)
    lines = [ln for ln in r.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, r.stdout + r.stderr[-2000:]
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out) and out["unit"] == "sec"
    assert out["queries"]["dash_kpi"] > 0
