"""Registered corpus queries against SQL, and the plans of those that must stay native."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from basketry.llm import queries
from checks.compare import _sorted_rows, duckdb_tables

TABLES = "/root/testdata/sf0.001"
SQL = queries.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duckdb_tables(TABLES)


def test_registered():
    names = entry_point.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, connection: duckdb.DuckDBPyConnection, name):
    found = queries.queries()[name](spark, TABLES)
    wanted = connection.execute(SQL[name])
    names = [column[0] for column in wanted.description]
    assert sorted(names) == sorted(found.columns)
    ours, theirs = _sorted_rows(found.columns, found.collect()), _sorted_rows(names, wanted.fetchall())
    assert ours == theirs
    assert [list(map(type, row)) for row in ours] == [list(map(type, row)) for row in theirs]


@pytest.mark.parametrize("number", [1, 2, 7, 9])
def test_native_queries_run_no_python(spark, number):
    name = next(n for n in queries.queries() if n.startswith(f"op{number}_"))
    plan = queries.queries()[name](spark, TABLES)._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
