"""Driver contract: entry() runs; every oracle key is a query; the oracle
queries equal DuckDB at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from txnguard.adapters import TABLES

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "fraud_rate" in df.columns


def test_oracle_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=lambda t: tuple(str(x) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert banned not in plan, f"{name} plans {banned}"
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())
