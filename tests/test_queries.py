"""Every registered query of the library against its SQL, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from tidewright.plans import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()
#: Held against plain code in test_operators.py; the approximate neighbours in test_vector_index.py, the communities in test_modularity.py.
NO_SQL = {"html_to_text_full", "surrogate_id", "extract_pipeline", "robots_cache", "embedding_ann", "modular_communities"}


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for p in Path(small).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}/*.parquet')" if p.is_dir() else f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return repr(value) if isinstance(value, float | bool | int) else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, small, duck):
    df = QUERIES[name](spark, small)
    columns = sorted(df.columns)
    got = sorted(([plain(r[c]) for c in columns] for r in df.collect()), key=repr)
    if name not in SQL:
        assert name in NO_SQL and got
        return
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(([plain(r[names.index(c)]) for c in columns] for r in result.fetchall()), key=repr)
    assert got == want


def test_daily_filter_reaches_the_scan(spark, small):
    plan = QUERIES["daily_cost_total"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts" in plan and "text" not in plan


def test_policy_join_is_a_broadcast(spark, small):
    assert "BroadcastHashJoin" in QUERIES["llm_gate"](spark, small)._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
