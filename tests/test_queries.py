from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import oracle, oracle_rows, spark_rows


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle(sf_dir)


@pytest.mark.parametrize("name", entry.own_queries())
def test_query_equals_its_sql(spark, sf_dir, connection, name):
    got = spark_rows(entry.own_queries()[name](spark, sf_dir))
    assert got == oracle_rows(connection, entry.oracle_sql()[name])


def test_every_query_has_its_sql():
    assert entry.own_queries().keys() <= entry.oracle_sql().keys()


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = entry.scan_filter_project(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,purchase)" in plan or "In(event_type" in plan
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in plan
