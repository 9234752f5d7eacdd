"""Every registered query equals its SQL, and its plan scales."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from parcelflow.expected_sql import ORACLE
from parcelflow.queries import QUERIES
from tests.compare import database, difference

SQL = ORACLE


@pytest.fixture(scope="module")
def con(tables):
    return database(tables)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql_without_slow_operators(spark, tables, con, name):
    df = driver.queries()[name](spark, tables)
    assert difference(df, con, SQL[name]) is None
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
        assert operator not in plan(df)


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_staging_reads_one_topic_and_the_contract_fields_only(spark, tables):
    text = plan(driver.queries()["stg_payments"](spark, tables))
    assert "kafka_topic" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    schema = text.split("ReadSchema: ")[1]
    assert "payload:struct<" in schema and "variant" not in schema
    assert "Exchange" not in text


def test_counting_reads_no_columns(spark, tables):
    from parcelflow.queries import landed

    text = plan(landed(spark, tables).raw_events().groupBy().count())
    assert "ReadSchema: struct<>" in text
