"""Driver contract: entry() smoke check and every registered query against its
DuckDB oracle on the smallest scale factor."""

import pytest

from conftest import SF_SMOKE

import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "week_start" in df.columns


def test_every_query_has_an_oracle_or_is_listed():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    # Only training-data operators may lack SQL; their own tests hold them against brute force.
    assert all(n == "pipeline" or n.startswith("op") for n in set(q) - set(o))


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, name):
    import sys
    import os
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    from oracle_check import rows_multiset

    duckdb = pytest.importorskip("duckdb")
    from quarry.plans.views import TABLES

    sdf = entry.queries()[name](spark, SF_SMOKE)
    srows = sdf.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(srows) > 0
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    cur = con.execute(sql)
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_multiset(sdf.columns, srows, True) == rows_multiset(dcols, drows, True)


def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "BENCH_SF_DIR": SF_SMOKE, "BENCH_CPUS": "2", "BENCH_REPEATS": "1",
           "BENCH_DRIVER_MEMORY": "2g"}
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py"), "table_shape", "top1"],
                         capture_output=True, text=True, env=env, timeout=600, cwd=root)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d) and d["unit"] == "sec"
    assert set(d["queries"]) == {"table_shape", "top1"} and d["sf"] == 0.001
