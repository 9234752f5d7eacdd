"""The hot-key left join equals the plain left join."""

from __future__ import annotations

import pytest

from parcelflow.operators import joins
from parcelflow.operators.joins import hot_keys, left_join

COLUMNS = ["k", "left_id", "right_id"]


@pytest.fixture(scope="module")
def sides(spark):
    # a third of the right side is key 7, a twentieth has no key; the left side misses often
    right = spark.range(30000).selectExpr(
        "case when id % 3 = 0 then 7 when id % 20 = 1 then null else id end k", "id right_id"
    )
    left = spark.range(400).selectExpr("case when id % 100 = 0 then 7 when id % 9 = 1 then null else id * 2 end k", "id left_id")
    return left, right


def assert_plain(left, right, hot):
    split = left_join(left, right, "k", "right_id", hot).select(COLUMNS)
    plain = left.join(right, "k", "left").select(COLUMNS)
    assert split.count() == plain.count()
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


def test_hot_keys_are_found(spark, sides):
    assert hot_keys(sides[1], "k", rows_per_task=1000) == [(7, 11)]


def test_small_tables_have_none(sides):
    assert hot_keys(sides[1], "k") == []


def test_key_of_every_row(spark):
    assert hot_keys(spark.range(5000).selectExpr("cast(null as bigint) k"), "k", 1) == []
    assert hot_keys(spark.range(5000).selectExpr("1L k"), "k", 100) == [(1, 50)]


@pytest.mark.parametrize("rows_per_task", [500, 3000])
def test_equals_the_plain_join(sides, rows_per_task):
    assert_plain(*sides, hot_keys(sides[1], "k", rows_per_task))


@pytest.mark.parametrize(
    "hot",
    [
        [(99, 2)],  # a listed key that the right side lacks
        [(7, 3), (8, 5), (10**9, 4), (2, 0)],
        [(7, 1)],
        [(None, 3), (7, 2)],
        [(7, 2), (7, 5)],
        [(2 * i, 2) for i in range(400)],  # every left key
    ],
)
def test_any_list_is_exact(sides, hot):
    assert_plain(*sides, hot)
    assert_plain(sides[0], sides[1].limit(0), hot)


def test_one_row_without_partner(spark):
    left = spark.createDataFrame([(99, 1), (1, 2)], "k long, left_id long")
    right = spark.createDataFrame([(1, 5)], "k long, right_id long")
    assert left_join(left, right, "k", "right_id", [(99, 2)]).count() == 2


def test_long_lists_stay_distributed(sides, monkeypatch):
    monkeypatch.setattr(joins, "MAX_LISTED", 0)
    hot = hot_keys(sides[1], "k", 1000)
    assert hot.columns == ["k", "pieces"]
    assert_plain(*sides, hot)
    with pytest.raises(ValueError, match="hot keys"):
        left_join(*sides, "k", "right_id", [(7, 2)])


def test_text_keys(spark):
    right = spark.range(3000).selectExpr("if(id % 2 = 0, 'hot', string(id)) k", "id right_id")
    left = spark.createDataFrame([("hot", 1), ("1", 2), ("none", 3), (None, 4)], "k string, left_id int")
    assert_plain(left, right, hot_keys(right, "k", 100))


def test_the_plain_plan_is_used_without_hot_keys(sides):
    left, right = sides
    plan = left_join(left, right, "k", "right_id", [])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_few_left_rows_are_not_copied(sides):
    left, right = sides
    joined = left_join(left, right, "k", "right_id", [(7, 30), (99, 2), (8, 2)])
    assert "Generate" not in joined._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("most", [0, 3, 4])  # four left rows have the hot key
def test_both_ways_of_a_hot_key_are_exact(sides, most, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", most)
    assert_plain(*sides, [(7, 3), (8, 5), (10**9, 4), (None, 2), (7, 5)])
    assert left_join(*sides, "k", "right_id", [(7, 3)]).columns == sides[0].join(sides[1], "k", "left").columns


def test_tiles_of_left_rows_are_exact(sides, spark, monkeypatch):
    monkeypatch.setattr(joins, "_TILE", 3)
    left = sides[0].unionAll(spark.range(20).selectExpr("case when id < 10 then 7 when id < 17 then 8 end k", "id % 4 left_id"))
    right = sides[1].unionAll(spark.range(5).selectExpr("8L k", "id % 2 right_id"))
    assert_plain(left, right, [(7, 3), (8, 5), (10**9, 4), (None, 2)])


@pytest.mark.parametrize(
    ("kind", "keys", "hot"),
    [
        ("string", ["7", "07", "7", " 7", "8", None, "007"], 7),  # some equal the right side's number only
        ("double", [0.0, -0.0, float("nan"), 0.0, None, 1.0, -0.0], 0),
    ],
)
def test_tiles_of_keys_of_another_type_are_exact(spark, monkeypatch, kind, keys, hot):
    monkeypatch.setattr(joins, "_TILE", 2)
    left = spark.createDataFrame(list(zip(keys, range(len(keys)), strict=True)), f"k {kind}, left_id long")
    right = spark.range(60).selectExpr(f"if(id % 2 = 0, {hot}, id) k", "id right_id")
    assert_plain(left, right, [(hot, 3)])


def test_the_product_of_a_hot_key_is_stored_in_a_third_of_a_byte_a_row(spark, tmp_path):
    left, right = spark.range(4000).selectExpr("7L k", "id left_id"), spark.range(1000).selectExpr("7L k", "id right_id")
    left_join(left, right, "k", "right_id", [(7, 1)]).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows").count()
    assert rows == 4_000_000
    assert sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) < rows / 3  # 0.58 bytes a row where all left rows follow one right row


def test_keys_in_no_full_bucket_are_not_counted_one_by_one(spark, monkeypatch):
    even = spark.range(40000).selectExpr("id k")
    odd = even.unionAll(spark.range(900).selectExpr("5L k")).unionAll(spark.range(900).selectExpr("cast(null as bigint) k"))
    monkeypatch.setattr(joins, "_BUCKETS", 16)
    limits = []
    original = type(even).groupBy
    monkeypatch.setattr(type(even), "groupBy", lambda df, *cols: limits.append(cols) or original(df, *cols))
    assert hot_keys(even, "k", 800) == [] and len(limits) == 1  # by buckets alone
    assert hot_keys(odd, "k", 800) == [(5, 2)] and len(limits) == 3


def test_a_sieve_loses_no_row(sides, spark, monkeypatch):
    keys = spark.range(0, 30000, 3).selectExpr("id k").unionAll(spark.createDataFrame([(7,), (None,)], "k long"))
    some = sides[1].selectExpr("k", "right_id")
    plain = {how: some.join(keys, "k", how) for how in ("left_semi", "left_anti")}
    monkeypatch.setattr(joins, "SIEVE_FROM", 1)
    for how, way in (("left_semi", joins.with_key_in), ("left_anti", joins.without_key_in)):
        found = way(some, keys, "k")
        assert "_may" not in found.columns and "_bits_0" in found._jdf.queryExecution().optimizedPlan().toString()
        assert found.exceptAll(plain[how]).isEmpty() and plain[how].exceptAll(found).isEmpty()
    assert joins.with_key_in(some, keys.limit(0), "k").isEmpty()
    assert joins.without_key_in(some, keys.selectExpr("cast(k as int) k"), "k").count() == plain["left_anti"].count()
