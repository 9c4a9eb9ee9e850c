"""Every registered query against its DuckDB oracle on sf0.001 (the driver's
gate runs the same at sf0.01), plus the entry smoke check."""

import hashlib
import json
import os

import duckdb
import pytest

import __spark_entry__ as E
from provena.session import TABLES

from .conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["event_id", "lineage_id", "dep_type", "expression", "inputs",
                          "process_qualified_name", "operation_type", "query_text"]
    assert df.count() > 0


# Plan nodes that must never appear: Python evaluated per row or per group, and
# joins that pair every row with every row.
FORBIDDEN_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                   "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in FORBIDDEN_NODES if n in plan], plan
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)
