"""Constraints, insert-or-ignore and the starter rows."""

from __future__ import annotations

import pytest

from parcelflow.operators import quality
from parcelflow.operators.conflicts import insert_ignore
from parcelflow.operators.quality import ConstraintViolation
from parcelflow.plans.build import Warehouse


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "a", 5), (2, "a", -1), (2, None, None), (None, None, 0)], "id int, name string, price int"
    )


def test_not_null(people):
    assert quality.check_not_null(people, ["id", "name"]).count() == 2


def test_unique_ignores_nulls(people):
    assert [tuple(r) for r in quality.check_unique(people, ["name"]).collect()] == [("a", 2)]
    assert quality.check_unique(people, ["id", "name"]).isEmpty()


def test_rule_passes_null_and_zero(people):
    assert [r["price"] for r in quality.check_rule(people, "price >= 0").collect()] == [-1]


def test_primary_key(people):
    found = quality.check_primary_key(people, ["id"]).collect()
    assert sorted((r["id"] or 0, r["row_count"]) for r in found) == [(0, 1), (2, 2)]


def test_relationship(spark, people):
    parent = spark.createDataFrame([(1,)], "key int")
    assert [r["id"] for r in quality.check_relationship(people, "id", parent, "key").collect()] == [2, 2]


def test_gate(people):
    with pytest.raises(ConstraintViolation, match="price"):
        quality.require("price", quality.check_rule(people, "price >= 0"))
    quality.require("fine", quality.check_rule(people, "price < 100"))


def test_first_row_per_key_wins(spark):
    rows = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y"), (4, None), (5, None)], "pos int, name string")
    kept = insert_ignore(rows, "name", "pos")
    assert sorted(r["pos"] for r in kept.collect()) == [1, 2, 4, 5]
    target = spark.createDataFrame([("y",)], "name string")
    assert sorted(r["pos"] for r in insert_ignore(rows, "name", "pos", target).collect()) == [1, 4, 5]


def test_seeding_twice_equals_once(spark, folder):
    warehouse = Warehouse(spark, folder)
    for _ in range(2):
        warehouse.seed()
        sizes = {n: warehouse.source(n).count() for n in ("raw_categories", "raw_products", "raw_customers")}
        assert sizes == {"raw_categories": 10, "raw_products": 30, "raw_customers": 10}


@pytest.mark.parametrize(
    "row,problem",
    [("(1, 'New', 1.0, 1)", "primary key taken"), ("(90, 'New', -0.01, 1)", "price"), ("(90, 'New', NULL, 1)", "not null")],
)
def test_violations_insert_nothing(spark, folder, row, problem):
    warehouse = Warehouse(spark, folder)
    warehouse.seed()
    new = spark.sql(
        f"SELECT bigint(product_id) product_id, name, cast(price AS decimal(10,2)) price, current_timestamp() ingested_at, category_id "
        f"FROM VALUES {row} AS t(product_id, name, price, category_id)"
    )
    with pytest.raises(ConstraintViolation, match=problem):
        warehouse.insert("raw_products", new)
    assert warehouse.source("raw_products").count() == 30


def test_a_free_price_and_an_open_category_are_fine(spark, folder):
    warehouse = Warehouse(spark, folder)
    warehouse.insert(
        "raw_products",
        spark.sql("SELECT 1L product_id, 'Gift' name, cast(0 as decimal(10,2)) price, current_timestamp() ingested_at, int(NULL) category_id"),
    )
    assert warehouse.source("raw_products").count() == 1
