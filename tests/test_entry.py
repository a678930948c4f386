"""Driver contract: entry() smoke, every query against its DuckDB oracle, plan hygiene."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from citylake.plans.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "labels"]


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6) + 0.0
        return v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["neighborhood_id", "district", "numMarkets", "average"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.oracle_sql()) >= 30


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables absent")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    assert canon(rows, cols) == canon(res.fetchall(), ocols)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_have_no_python_or_cartesian(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"
