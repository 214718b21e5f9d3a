"""Every registered query equals its DuckDB oracle on the sf0.001 tables (exact values)."""
import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from wxodds.plans.registry import ORACLE, QUERIES
from wxodds.sources.tables import TABLES


def _norm(v):
    if isinstance(v, float):
        return ("f", repr(v))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, decimal.Decimal):
        return ("d", str(v))
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    return ("s", str(v)) if v is not None else ("n",)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["location_name", "accuracy"] and df.count() > 0


FORBIDDEN_IN_PLAN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in FORBIDDEN_IN_PLAN if w in plan], "no cross joins or Python in batch plans"
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == want
