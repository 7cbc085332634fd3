import pytest
from compare import compare

import __spark_entry__ as driver

# Those of the llm folder have tests of their own, which go with it.
QUERIES = {name: query for name, query in driver.queries().items() if name not in driver.LLM_QUERIES}
SQL = {name: sql for name, sql in driver.oracle_sql().items() if name not in driver.LLM_SQL}
# Queries that write a lake of their own before they return.
WRITING = ("pipeline", "bronze_full", "table_exists", "serve", "csv_", "bronze_stocks")


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    fact = driver.entry(spark)
    assert fact.columns[0] == "product_sk" and fact.count() == 6000


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_result_as_sql(spark, sf_dir, tables, name):
    assert compare(QUERIES[name](spark, sf_dir), tables, SQL[name]) is None


@pytest.mark.parametrize("name", [name for name in QUERIES if not name.startswith(WRITING)])
def test_no_plan_pairs_all_rows_or_sorts_in_one_task(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "Python", "LeftAnti, BuildRight, true"):
        assert unwanted not in plan
