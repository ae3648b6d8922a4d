"""Every plan with SQL gives the rows that DuckDB gives on the smallest tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from quernstone.plans import catalog

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{ROOT}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return value


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_plan(spark, sql, name):
    got = catalog.queries()[name](spark, ROOT)
    rows = Counter(tuple(plain(r[c]) for c in sorted(got.columns)) for r in got.collect())
    if name not in catalog.oracle_sql():
        return
    answer = sql.sql(catalog.oracle_sql()[name])
    order = [answer.columns.index(c) for c in sorted(got.columns)]
    assert sorted(answer.columns) == sorted(got.columns)
    assert rows == Counter(tuple(plain(r[k]) for k in order) for r in answer.fetchall())


def test_no_all_pairs_and_no_row_python(spark):
    for name, run in catalog.queries().items():
        plan = run(spark, ROOT)._jdf.queryExecution().executedPlan().toString()
        assert not any(bad in plan for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")), name
