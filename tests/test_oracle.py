"""Every registered query against its DuckDB SQL, and what no plan may hold."""

import pytest
from compare import database, differences

import __spark_entry__ as entry


FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonUDF",
             "MapInPandas", "ExistingRDD"]


def forbidden_parts(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [word for word in FORBIDDEN if word in plan]


@pytest.fixture(scope="module")
def connection(small):
    return database(small)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "order_month"


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry.library_queries()) == set(entry.library_oracles())


@pytest.mark.parametrize("name", list(entry.library_oracles()))
def test_query(spark, connection, small, name):
    df = entry.queries()[name](spark, small)
    assert forbidden_parts(df) == []
    assert differences(df, connection, entry.oracle_sql()[name]) is None
