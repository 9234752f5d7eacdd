"""Facts refreshed from changes equal facts built in full, and leave other parts alone."""

from __future__ import annotations

import json
import random
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.operators.versioned import VersionedTable
from parcelflow.plans import marts
from parcelflow.plans.build import Warehouse
from parcelflow.sources.seeds import seed_categories, seed_customers, seed_products
from tests.helpers import frame, message

FACTS = ("fct_orders", "fct_payments", "fct_shipments")


def order(offset, order_id, product=1, customer=1):
    body = {"order_id": order_id, "customer_id": customer, "product_id": product, "unit_price": 2.5, "currency": "USD"}
    return message(json.dumps(body), topic="orders", offset=offset)


def payment(offset, payment_id, order_id):
    return message(json.dumps({"payment_id": payment_id, "order_id": order_id, "amount": 3.5}), topic="payments", offset=offset)


def shipment(offset, shipment_id, payment_id, order_id):
    body = {"shipment_id": shipment_id, "payment_id": payment_id, "order_id": order_id}
    return message(json.dumps(body), topic="shipments", offset=offset)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def in_full(w):
    """The facts from the staged tables, by the plain joins."""
    orders = marts.fct_orders(w.ref("stg_orders"), w.ref("dim_customers"), w.ref("dim_products"), w.ref("dim_categories"))
    payments, shipments = w.ref("stg_payments"), w.ref("stg_shipments")
    return [orders, marts.fct_payments(payments, orders), marts.fct_shipments(shipments, payments, orders)]


def check(w, *names):
    for name, wanted in zip(FACTS, in_full(w), strict=True):
        if name in names or not names:
            assert w.ref(name).columns == wanted.columns
            assert rows(w.ref(name)) == rows(wanted), name


def follow(w, *names):
    """Bring staging tables and facts up to date one by one; the dimensions are not concerned."""
    for name in names or ("stg_orders", "stg_payments", "stg_shipments", *FACTS):
        w.materialize(name)


@pytest.fixture(scope="module")
def first_build(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    w = Warehouse(spark, root, block_bits=6, fact_parts=4)
    w.insert("raw_categories", seed_categories(spark))
    w.insert("raw_products", seed_products(spark).filter("product_id <> 2"))
    w.insert("raw_customers", seed_customers(spark))
    first = [order(i, i) for i in range(20)] + [payment(i, 100 + i, i) for i in range(25)]
    first += [shipment(i, 200 + i, 100 + i, i) for i in range(30)]
    w.log.append(frame(spark, *first))
    w.build()
    assert set(w.refreshed.values()) == {"full"}
    check(w)
    return root


@pytest.fixture
def warehouse(spark, first_build, folder):
    """A copy of the first build; manifests name no absolute paths."""
    shutil.copytree(first_build, f"{folder}/copy")
    return Warehouse(spark, f"{folder}/copy", block_bits=6, fact_parts=4)


def parts(w, name):
    return {part: {load for load, p in w._stored(name).state().folders() if p == part} for part in range(4)}


def test_new_rows_are_added_to_their_parts_only(spark, warehouse):
    before = {name: parts(warehouse, name) for name in FACTS}
    warehouse.log.append(frame(spark, order(300, 300), payment(300, 400, 300)))
    follow(warehouse)
    assert warehouse.refreshed == {"fct_orders": "changes", "fct_payments": "changes", "fct_shipments": "nothing"}
    check(warehouse)
    for name, added in (("fct_orders", 1), ("fct_payments", 1), ("fct_shipments", 0)):
        after = parts(warehouse, name)
        assert all(before[name][part] <= after[part] for part in range(4))  # nothing was rewritten
        assert sum(len(after[p]) - len(before[name][p]) for p in range(4)) == added
    last = {name: warehouse._stored(name).state().last for name in FACTS}
    warehouse.build()  # nothing new commits nothing
    assert set(warehouse.refreshed.values()) == {"nothing"}
    assert last == {name: warehouse._stored(name).state().last for name in FACTS}


def test_a_late_order_takes_back_the_bare_payment(spark, warehouse):
    before = parts(warehouse, "fct_payments")
    warehouse.log.append(frame(spark, order(50, 22), order(51, 3, product=4)))
    follow(warehouse)
    assert warehouse.refreshed["fct_payments"] == "changes"
    check(warehouse, "fct_payments", "fct_shipments")
    found = warehouse.ref("fct_payments").filter("payment_id in (103, 122, 124)").groupBy("payment_id").agg(
        F.count("*").alias("n"), F.count("product_id").alias("matched")
    )
    assert rows(found) == [(103, 2, 2), (122, 1, 1), (124, 1, 0)]
    after = parts(warehouse, "fct_payments")
    touched = {r[0] for r in spark.sql("select pmod(xxhash64(cast(x as bigint)), 4) from values (22), (3) as t(x)").collect()}
    assert all((before[p] == after[p]) == (p not in touched) for p in range(4))


def test_a_late_payment_and_a_late_dimension(spark, warehouse):
    warehouse.log.append(frame(spark, payment(60, 127, 27), order(60, 60, product=2), order(61, 61, product=2)))
    follow(warehouse)
    check(warehouse, "fct_shipments")
    assert warehouse.ref("fct_orders").filter("product_id = 2").agg(F.count("product_name")).head()[0] == 0
    warehouse.insert("raw_products", seed_products(spark))
    warehouse.build()
    check(warehouse)
    assert warehouse.refreshed["fct_orders"] == "changes"
    assert warehouse.ref("fct_orders").filter("product_id = 2").agg(F.count("product_name")).head()[0] == 2


def test_corrected_rows_replace_theirs(spark, warehouse):
    staged = warehouse.ref("stg_payments").filter("payment_id in (101, 102)").withColumn("amount", F.col("amount") + 1)
    warehouse._incremental("stg_payments").upsert(staged.withColumn("order_id", F.col("order_id") + 1))
    follow(warehouse, "fct_payments", "fct_shipments")
    check(warehouse, "fct_payments", "fct_shipments")
    assert warehouse.refreshed["fct_payments"] == "changes"


def test_many_changes_build_in_full(spark, warehouse):
    warehouse.log.append(frame(spark, *[order(i, i % 7) for i in range(100, 160)]))
    follow(warehouse, "stg_orders", "fct_orders", "fct_payments")
    assert warehouse.refreshed["fct_orders"] == "full"
    check(warehouse, "fct_orders", "fct_payments")


def test_a_fact_that_missed_builds_is_built_in_full(spark, warehouse, monkeypatch):
    from parcelflow.operators import versioned

    monkeypatch.setattr(versioned, "_MANIFEST_COMMITS", 1)
    for i in range(2):
        warehouse.log.append(frame(spark, order(500 + i, 500 + i)))
        warehouse.materialize("stg_orders")
    follow(warehouse, "fct_orders")
    assert warehouse.refreshed["fct_orders"] == "full"
    check(warehouse, "fct_orders")


def test_a_refresh_that_dies_is_repeated(spark, warehouse, monkeypatch):
    from parcelflow.operators.versioned import VersionedTable

    before = rows(warehouse.ref("fct_payments"))
    warehouse.log.append(frame(spark, order(50, 22)))
    follow(warehouse, "stg_orders", "fct_orders")
    with monkeypatch.context() as broken:
        broken.setattr(VersionedTable, "_commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            warehouse.materialize("fct_payments")
    assert rows(warehouse.ref("fct_payments")) == before
    follow(warehouse, "fct_payments")
    check(warehouse, "fct_payments")


def test_random_arrivals(spark, warehouse):
    rng = random.Random(1)
    for step in range(2):
        at = 1000 + 100 * step
        batch = [order(at + i, rng.randrange(40), rng.randrange(4), rng.randrange(13)) for i in range(rng.randrange(6))]
        batch += [payment(at + i, 100 + rng.randrange(40), rng.choice([None, *range(40)])) for i in range(rng.randrange(6))]
        batch += [shipment(at + i, 700 + i, 100 + rng.randrange(40), rng.randrange(40)) for i in range(rng.randrange(6))]
        if batch:
            warehouse.log.append(frame(spark, *batch))
        follow(warehouse)
    check(warehouse)


def test_changed_keys_tell_a_value_from_a_null(spark, folder):
    table = VersionedTable(spark, folder, T.StructType.fromDDL("k bigint, a bigint, b bigint"))
    rows = spark.createDataFrame([(1, 5, None, 0), (2, 5, None, 0), (3, 1, 1, 1), (4, 1, 1, 0)], "k bigint, a bigint, b bigint, part bigint")
    table.commit(rows)
    moved = spark.createDataFrame([(1, None, 5, 0), (2, 5, None, 0), (4, 1, 1, 0), (4, 1, 1, 0)], "k bigint, a bigint, b bigint, part bigint")
    table.commit(moved, [0])
    found = table.changes_since(1, "k")
    assert found.columns == ["k", "added"]
    assert sorted(map(tuple, found.collect())) == [(1, -1), (1, 1), (4, 1)]


def test_a_build_in_full_does_not_read_the_changes_first(spark, warehouse, monkeypatch):
    w = warehouse
    w.log.append(frame(spark, *[order(i, i) for i in range(100, 130)]))
    monkeypatch.setattr(VersionedTable, "changes_since", lambda *args: pytest.fail("the manifest tells how much was added"))
    follow(w, "stg_orders", "fct_orders")
    assert w.refreshed["fct_orders"] == "full" and w.ref("fct_orders").count() == w.ref("stg_orders").count()
