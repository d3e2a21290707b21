"""Every named query against its SQL, and the shape of every plan."""

import pytest

import __spark_entry__ as entry_points
from parity import compare, connect
from velomet.plans.oracle import ORACLE_SQL as SQL
from velomet.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert QUERIES.items() <= entry_points.queries().items()
    assert SQL.items() <= entry_points.oracle_sql().items()
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[:2] == ["date", "num_trips"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    if name in SQL:
        assert compare(df, con, SQL[name]) == []
    else:
        df.collect()
