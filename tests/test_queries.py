"""Every query against its SQL, and what their plans must not contain."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from registry.check import compare, connect
from registry.oracles import SQL
from registry.queries import registered

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registered()) == set(SQL)
    assert set(registered()) <= set(queries()) and set(SQL) <= set(oracle_sql())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "base_priority" in df.columns


@pytest.mark.parametrize("name", list(registered()))
def test_query(spark, db, name):
    df = queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("PythonUDF", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert bad not in plan
    assert compare(df, db, oracle_sql()[name]) is None
