"""Models, the build, and their expected values on the given tables."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from parcelflow import configure
from parcelflow.plans import marts, staging
from parcelflow.plans.build import MODELS, Warehouse
from parcelflow.queries import new_warehouse, raw
from parcelflow.sources import order_tables as source
from tests.helpers import frame, message


@pytest.fixture(scope="module")
def built(spark):
    warehouse = new_warehouse(spark, "/root/testdata/sf0.001")
    counts = {r["model"]: r["row_count"] for r in warehouse.build().collect()}
    return warehouse, counts


def test_row_counts(built):
    _, counts = built
    assert list(counts) == list(MODELS)
    assert (counts["stg_orders"], counts["stg_payments"], counts["stg_shipments"]) == (1500, 986, 493)
    assert counts["fct_orders"] == 1500
    assert counts["fct_payments"] >= counts["stg_payments"]
    assert counts["fct_shipments"] == 512


def test_sums(built):
    warehouse, _ = built
    assert warehouse.ref("fct_orders").agg(F.sum("revenue")).head()[0] == Decimal("1002562069.77")
    assert warehouse.ref("fct_shipments").agg(F.sum("payment_amount")).head()[0] == Decimal("349460494.35")
    named = warehouse.ref("fct_orders").agg(F.count("product_name"), F.count("category_name")).head()
    assert tuple(named) == (765, 675)


def test_types(built):
    warehouse, _ = built
    types = dict(warehouse.ref("fct_payments").dtypes)
    assert types["unit_price"] == "decimal(10,2)"
    assert types["payment_amount"] == "decimal(12,2)"
    assert types["revenue"] == "decimal(21,2)"
    assert types["payment_date"] == types["ingested_at"] == "timestamp"
    assert types["category_id"] == types["quantity"] == "int"


def test_build_is_repeatable(built):
    warehouse, counts = built
    before = sorted(warehouse.ref("fct_shipments").collect(), key=str)
    for mode in ("keyed", "strict"):
        assert {r["model"]: r["row_count"] for r in warehouse.build(mode).collect()} == counts
    assert sorted(warehouse.ref("fct_shipments").collect(), key=str) == before


def test_shuffle_size(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        configure(spark, shuffle_bytes=20 << 30)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "103"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_sql_access(spark, built):
    warehouse, counts = built
    warehouse.declare("raw", "wh")
    row = spark.sql(
        "SELECT (SELECT count(*) FROM raw.raw_events) raw, (SELECT count(*) FROM wh.fct_orders) orders, "
        "(SELECT count(product_name) FROM wh.stg_products) products"
    ).head()
    assert tuple(row) == (2979, counts["fct_orders"], counts["stg_products"])
    assert warehouse.status().head().asDict() == {
        "raw_events_count": 2979,
        "fct_orders_count": counts["fct_orders"],
        "fct_payments_count": counts["fct_payments"],
        "fct_shipments_count": counts["fct_shipments"],
    }


def test_new_events_are_picked_up_and_heal_the_facts(spark, folder):
    warehouse = Warehouse(spark, folder)
    warehouse.seed()
    payment = '{"payment_id":1,"order_id":10,"customer_id":2,"amount":20,"currency":"EUR","payment_date":"2024-01-01T00:00:00"}'
    order = '{"order_id":10,"customer_id":2,"product_id":3,"quantity":2,"unit_price":10,"currency":"EUR","timestamp":"2024-01-01T00:00:00"}'
    warehouse.log.append(frame(spark, message(payment, topic="payments")))
    warehouse.build()
    assert warehouse.ref("fct_payments").select("product_id").collect() == [(None,)]
    warehouse.log.append(frame(spark, message(order)))
    warehouse.build()
    row = warehouse.ref("fct_payments").head()
    assert (row["product_name"], row["category_name"], row["revenue"]) == ("Headphones", "Electronics", Decimal(20))


def test_a_malformed_field_stops_the_build_or_is_set_aside(spark, folder):
    messages = frame(spark, message('{"order_id":"x"}'), message('{"order_id":5,"unit_price":1}', offset=1))
    strict = Warehouse(spark, folder)
    strict.log.append(messages)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        strict.build()
    lenient = Warehouse(spark, folder, on_error="quarantine")
    for _ in range(2):
        lenient.build()
        assert [r["order_id"] for r in lenient.ref("fct_orders").collect()] == [5]
    assert [(r["event_id"], r["failed_fields"]) for r in lenient.failed("orders").collect()] == [("orders-0-0", ["order_id"])]


def test_missing_and_null_dimension_keys_keep_the_row(spark):
    orders = spark.sql(
        "SELECT 1L order_id, timestamp '2024-01-01' order_ts, 'EUR' currency, customer_id, product_id, 1 quantity, "
        "cast(5 as decimal(10,2)) unit_price, 'orders' kafka_topic, 0 kafka_partition, 0L kafka_offset, "
        "timestamp '2024-01-01' ingested_at FROM VALUES (1L, 1L), (NULL, NULL), (9L, 2L) t(customer_id, product_id)"
    )
    customers = spark.sql("SELECT 1L customer_id, 'A' customer_name")
    products = spark.sql("SELECT * FROM VALUES (1L, 'P', 7), (2L, 'Q', NULL) t(product_id, product_name, category_id)")
    categories = spark.sql("SELECT 8L category_id, 'C' category_name")
    rows = marts.fct_orders(orders, customers, products, categories).collect()
    found = sorted(((r["customer_name"], r["product_name"], r["category_id"], r["category_name"]) for r in rows), key=str)
    assert found == [("A", "P", 7, None), (None, "Q", None, None), (None, None, None, None)]


def test_splitting_hot_orders_does_not_change_the_facts(spark, tables):
    events = raw(spark, tables)
    orders = staging.stg_orders(events).withColumn("order_id", F.expr("if(order_id % 3 = 0, 3, order_id)"))
    payments = staging.stg_payments(events).limit(200).withColumn("order_id", F.expr("if(order_id % 50 = 0, 3, order_id)"))
    facts = marts.fct_orders(
        orders,
        staging.stg_customers(source.raw_customers(spark, tables)),
        staging.stg_products(source.raw_products(spark, tables)),
        staging.stg_categories(source.raw_categories(spark, tables)),
    )
    plain = marts.fct_payments(payments, facts)
    split = marts.fct_payments(payments, facts, [(3, 7), (4, 2)])
    assert split.count() == plain.count() > 500
    assert split.exceptAll(plain).isEmpty()
