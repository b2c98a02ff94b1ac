"""The driver contract, checked the way the driver checks it (on sf0.001)."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tidelog.workloads import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return "None" if v is None else str(v)


def table(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["top_ips", "top_endpoints"]
    assert len(df.collect()) == 1


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    res = duck.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(res.columns)
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table(res.columns, res.fetchall())
    plan = df.sparkSession.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython"):
        assert bad not in plan, f"{key} plans {bad}"
