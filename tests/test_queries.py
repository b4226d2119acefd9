"""Every registered query against its SQL in DuckDB."""

import re

import pytest
from compare import differences, duck

import __spark_entry__ as entry
from martworks.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_each_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    result = QUERIES[name](spark, SF)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"EvalPython|MapInPandas|FlatMapGroups|CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert differences(result, con, SQL[name]) == []
