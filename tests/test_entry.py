"""Driver contract: entry smoke, registry consistency, and a sample of
registered queries against their DuckDB oracle on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
SAMPLE = sorted(E.oracle_sql())          # every oracle-backed query, on the smallest tables


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 0
    assert "homicide_rate" in df.columns and "region_name" in df.columns


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows, cols = df.collect(), df.columns
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    order = sorted(cols)
    s = sorted((tuple(_norm(r[c]) for c in order) for r in rows), key=repr)
    o = sorted((tuple(_norm(r[ocols.index(c)]) for c in order) for r in cur.fetchall()), key=repr)
    assert s == o


def test_no_nested_loop_or_cartesian_plans(spark):
    """Every registered query plans equi-joins only (no pair explosion)."""
    bad = []
    for name, fn in E.queries().items():
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        if "NestedLoopJoin" in plan or "CartesianProduct" in plan:
            bad.append(name)
    assert bad == []
