"""Strict and keyed loads, upsert, and recovery."""

from __future__ import annotations

import pytest

from parcelflow.operators.incremental import IncrementalTable, high_water_mark, incremental_filter

SCHEMA = "event_id string, kafka_offset bigint, amount int, ingested_at timestamp"


def rows(spark, *items):
    """(offset, amount, minute) -> a keyed row"""
    data = [(f"orders-0-{o}", o, a, m) for o, a, m in items]
    df = spark.createDataFrame(data, "event_id string, kafka_offset bigint, amount int, minute int")
    return df.selectExpr("event_id", "kafka_offset", "amount", "timestamp '2024-01-01' + make_interval(0,0,0,0,0,minute) ingested_at")


@pytest.fixture
def table(spark, folder):
    return IncrementalTable(spark, f"{folder}/t", rows(spark, (0, 0, 0)).schema, block_bits=3)


def content(table):
    return sorted((r["kafka_offset"], r["amount"]) for r in table.read().collect())


def test_first_run_loads_everything(spark, table):
    table.load_strict(rows(spark, (0, 1, 5), (9, 2, 1)))
    assert content(table) == [(0, 1), (9, 2)]
    assert table.mark() == high_water_mark(table.read())


def test_strict_skips_ties_and_late_rows(spark, table):
    table.load_strict(rows(spark, (0, 1, 5)))
    table.load_strict(rows(spark, (0, 1, 5), (1, 2, 5), (2, 3, 4), (3, 4, 6)))
    assert content(table) == [(0, 1), (3, 4)]


def test_keyed_finds_late_rows(spark, table):
    table.load_keyed(rows(spark, (0, 1, 5), (30, 1, 5)))
    table.load_keyed(rows(spark, (0, 1, 5), (30, 1, 5), (1, 2, 5), (2, 3, 4), (17, 4, 0), (31, 9, 9)))
    assert content(table) == [(0, 1), (1, 2), (2, 3), (17, 4), (30, 1), (31, 9)]
    table.load_keyed(rows(spark, (0, 1, 5), (30, 1, 5), (1, 2, 5), (2, 3, 4), (17, 4, 0), (31, 9, 9)))
    assert len(content(table)) == 6


def test_keyed_compares_only_incomplete_blocks(spark, table):
    table.load_keyed(rows(spark, (0, 1, 1), (8, 1, 1)))
    missing = table.missing_rows(rows(spark, (0, 1, 1), (8, 1, 1), (9, 1, 1), (20, 1, 1)))
    assert sorted(r["kafka_offset"] for r in missing.collect()) == [9, 20]


def test_upsert_replaces_and_inserts(spark, table):
    table.upsert(rows(spark, *[(i, i, 1) for i in range(32)]))
    table.upsert(rows(spark, (3, 100, 2), (40, 7, 2), (17, 200, 2)))
    expected = {i: i for i in range(32)} | {3: 100, 17: 200, 40: 7}
    assert content(table) == sorted(expected.items())


def test_upsert_leaves_other_blocks_alone(spark, table):
    table.upsert(rows(spark, *[(i, i, 1) for i in range(32)]))

    def others():
        return {f for f in table.read().inputFiles() if "part=0/" not in f}

    before = others()
    table.upsert(rows(spark, (3, 100, 2)))
    assert others() == before and len(before) >= 3


def test_a_batch_derived_from_the_table_itself(spark, table):
    table.upsert(rows(spark, *[(i, i, 1) for i in range(20)]))
    table.upsert(table.read().selectExpr("event_id", "kafka_offset", "amount + 1 amount", "ingested_at"))
    assert content(table) == [(i, i + 1) for i in range(20)]


@pytest.mark.parametrize("mode", ["strict", "keyed"])
def test_a_load_that_dies_before_its_commit_changes_nothing(spark, table, mode, monkeypatch):
    """Corrected rows survive, readers see the old rows, and the next load repeats the lost one."""
    table.load_keyed(rows(spark, (0, 1, 1), (1, 1, 1), (9, 1, 1)))
    table.upsert(rows(spark, (1, 50, 2)))
    source = rows(spark, (0, 1, 1), (1, 1, 1), (9, 1, 1), (2, 5, 9), (1, 70, 9) if mode == "strict" else (3, 6, 9))
    before = content(table)

    def dies(*args, **kwargs):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(type(table.table), "_commit", dies)
        with pytest.raises(RuntimeError, match="driver lost"):
            table.load_strict(source) if mode == "strict" else table.load_keyed(source)
    assert content(table) == before == [(0, 1), (1, 50), (9, 1)]
    table.table.vacuum()  # the lost load's files
    assert content(table) == before
    table.load_strict(source) if mode == "strict" else table.load_keyed(source)
    late = [(1, 70), (2, 5)] if mode == "strict" else [(1, 50), (2, 5), (3, 6)]
    assert content(table) == sorted([(0, 1), (9, 1), *late])


def test_a_reader_keeps_its_version(spark, table):
    table.upsert(rows(spark, *[(i, i, 1) for i in range(20)]))
    reader = table.read()
    table.upsert(rows(spark, (3, 100, 2)))
    assert reader.filter("amount = 100").count() == 0 and reader.count() == 20
    assert table.read().filter("amount = 100").count() == 1


def test_equal_counts_are_not_taken_for_equal_keys(spark, table):
    table.load_keyed(rows(spark, (0, 1, 1), (1, 1, 1)))
    table.load_keyed(rows(spark, (0, 1, 1), (2, 1, 1)))
    assert content(table) == [(0, 1), (1, 1), (2, 1)]


def test_many_changed_blocks_are_compared_by_a_join(spark, table, monkeypatch):
    from parcelflow.operators import incremental

    monkeypatch.setattr(incremental, "_MAX_BLOCK_FILTER", 1)
    table.load_keyed(rows(spark, *[(i, 1, 1) for i in range(0, 40, 2)]))
    table.load_keyed(rows(spark, *[(i, 2, 2) for i in range(60)]))
    assert content(table) == [(i, 1 if i < 40 and i % 2 == 0 else 2) for i in range(60)]


def test_any_key(spark, folder):
    """Rows move between offset blocks, and still replace each other by the declared key."""
    schema = rows(spark, (0, 0, 0)).schema
    table = IncrementalTable(spark, f"{folder}/by_amount", schema, key="amount", block_bits=3, buckets=4)
    table.upsert(rows(spark, (0, 7, 1), (50, 8, 1), (3, 9, 1)))
    table.upsert(rows(spark, (100, 7, 2), (1, 10, 2)))
    assert content(table) == [(1, 10), (3, 9), (50, 8), (100, 7)]
    table.load_keyed(rows(spark, (200, 7, 3), (201, 11, 3)))
    assert content(table) == [(1, 10), (3, 9), (50, 8), (100, 7), (201, 11)]


def test_rebuild_is_a_swap(spark, folder, monkeypatch):
    from parcelflow.operators.versioned import VersionedTable
    from parcelflow.plans.build import materialize_table

    first = materialize_table(rows(spark, (0, 1, 1)), f"{folder}/t")
    reader = first.read()
    with monkeypatch.context() as broken:
        broken.setattr(VersionedTable, "_commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            materialize_table(rows(spark, (5, 5, 5)), f"{folder}/t")
    assert [r["amount"] for r in first.read().collect()] == [1]
    second = materialize_table(rows(spark, (2, 2, 2), (3, 3, 3)), f"{folder}/t")
    assert reader.count() == 1 and second.count() == 2 == VersionedTable(spark, f"{folder}/t").read().count()
    assert spark.sql(second.sql(["amount"])).count() == 2
    assert materialize_table(rows(spark, (2, 2, 2)).limit(0), f"{folder}/t").read().count() == 0
    second.vacuum()
    assert second.count() == 0


def test_empty_batch(spark, table):
    table.load_strict(rows(spark, (0, 1, 1)).limit(0))
    table.load_keyed(rows(spark, (0, 1, 1)).limit(0))
    assert content(table) == [] and table.mark() is None


def test_filter_without_mark_keeps_all(spark):
    assert incremental_filter(rows(spark, (0, 1, 1)), None).count() == 1


def keyed(spark, *keys):
    """Rows whose key repeats: (key, position) pairs"""
    data = [(f"e{i}", i, k, i) for i, k in enumerate(keys)]
    df = spark.createDataFrame(data, "event_id string, kafka_offset bigint, amount int, minute int")
    return df.selectExpr("event_id", "kafka_offset", "amount", "timestamp '2024-01-01' + make_interval(0,0,0,0,0,minute) ingested_at")


@pytest.mark.parametrize(
    "stored,source,wanted",
    [
        ([1, 1], [2, 2], [1, 1, 2, 2]),  # an exclusive or of hashes takes both for nothing
        ([5, 1, 1], [5, 7, 7], [1, 1, 5, 7, 7]),
        ([1, 2, 3, 3], [3, 3, 2, 1], [1, 2, 3, 3]),
        ([1], [1, 1], [1]),
        ([None, None, 4], [4, 4, 6], [4, 6, None, None]),
    ],
)
def test_keyed_load_of_any_multiset_of_keys(spark, folder, stored, source, wanted):
    table = IncrementalTable(spark, folder, rows(spark, (0, 0, 0)).schema, key="amount", buckets=1)
    table.load_keyed(keyed(spark, *stored))
    table.load_keyed(keyed(spark, *source))
    assert sorted((r["amount"] for r in table.read().collect()), key=str) == sorted(wanted, key=str)


def test_digests_add_up_and_tell_multisets_apart(spark):
    from parcelflow.operators.versioned import key_digest

    def digest(*keys):
        return tuple(spark.createDataFrame([(k,) for k in keys], "k int").agg(*key_digest(["k"])).head())

    one, two = digest(1, 1, 5), digest(2, 2)
    assert digest(1, 1, 5, 2, 2) == tuple(a + b for a, b in zip(one, two))
    seen = [digest(*keys) for keys in ((1, 1), (2, 2), (1, 2), (3, 3), (1,), (0, 3))]
    assert len(set(seen)) == len(seen)


def test_parts_of_many_loads_are_merged_and_the_manifest_summed_up(spark, table, monkeypatch):
    from parcelflow.operators import incremental, versioned

    monkeypatch.setattr(incremental, "_MAX_LOADS", 3)
    monkeypatch.setattr(versioned, "_MANIFEST_COMMITS", 4)
    for i in range(7):
        table.tidy()
        table.load_keyed(rows(spark, (i, i, i), (8 + i, i, i)))
        assert content(table) == sorted([(k, k) for k in range(i + 1)] + [(8 + k, k) for k in range(i + 1)])
        assert max(len([f for f in table.table.state().folders() if f[1] == part]) for part in (0, 1)) <= 5
    mark = table.mark()
    table.tidy()
    table.table.vacuum()
    state = table.table.state()
    assert len({r["commit"] for r in state.rows}) <= 6 and table.mark() == mark
    assert len(content(table)) == 14 == state.count() == table.table.active().selectExpr("sum(row_count)").head()[0]
    assert spark.sql(table.table.sql(["amount"])).count() == 14
    table.load_keyed(rows(spark, (6, 9, 9), (7, 9, 9)))
    assert len(content(table)) == 15


def test_changes_since_a_commit(spark, table):
    def changes(commit):
        found = table.table.changes_since(commit)
        return None if found is None else sorted((r["kafka_offset"], r["amount"], r["added"]) for r in found.collect())

    table.load_keyed(rows(spark, (0, 1, 1), (1, 1, 1), (9, 1, 1)))
    first = table.table.state().last
    assert changes(first) == []
    table.load_keyed(rows(spark, (0, 1, 1), (2, 2, 2), (20, 2, 2)))
    assert changes(first) == [(2, 2, 1), (20, 2, 1)]
    table.upsert(rows(spark, (1, 7, 3), (30, 7, 3)))
    assert changes(first) == [(1, 1, -1), (1, 7, 1), (2, 2, 1), (20, 2, 1), (30, 7, 1)]
    table.table.merge([0])
    assert changes(table.table.state().last - 1) == []
    assert changes(0) is None


def test_a_rebuild_with_equal_rows_commits_nothing(spark, folder):
    from parcelflow.plans.build import materialize_table

    first = materialize_table(rows(spark, (0, 1, 1), (1, 2, 1), (1, 2, 1)), folder, only_changed=True)
    before = first.state().last
    assert materialize_table(rows(spark, (1, 2, 1), (0, 1, 1), (1, 2, 1)), folder, only_changed=True).state().last == before
    again = materialize_table(rows(spark, (1, 2, 1), (0, 1, 1)), folder, only_changed=True)
    assert again.state().last == before + 1 and again.count() == 2
    materialize_table(rows(spark, (0, 1, 1)).limit(0), folder, only_changed=True)
    assert again.count() == 0


def _events(spark, numbers, name="concat('orders-', id % 3, '-', id div 3)"):
    return spark.createDataFrame([(n,) for n in numbers], "id bigint").selectExpr(
        f"{name} event_id", "'orders' kafka_topic", "cast(id % 3 as int) kafka_partition", "id div 3 kafka_offset", "timestamp_seconds(id) ingested_at"
    )


@pytest.mark.parametrize("named_by_place", [True, False])
def test_missing_events_are_found_by_bits_of_their_places(spark, folder, named_by_place):
    """The load is not shuffled against the stored keys; events of other names are compared by name."""
    name = "concat('orders-', id % 3, '-', id div 3)" if named_by_place else "concat('e', id)"
    t = IncrementalTable(spark, f"{folder}/events", _events(spark, [0]).schema, block_bits=12)
    t.load_keyed(_events(spark, [*range(0, 5000, 2), 3072, 30_000], name))
    source = _events(spark, [*range(5000), 30_000, 1, 30_001], name)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        missing = t.missing_rows(source)
        plan = missing._jdf.queryExecution().executedPlan().toString()
        assert ("SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan) == named_by_place
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    wanted = _events(spark, [1, *range(1, 5000, 2), 30_001], name)
    assert sorted(missing.collect()) == sorted(wanted.collect())
    t.load_keyed(source)
    assert t.read().count() == 5004 and t.missing_rows(source).count() == 0


def test_events_of_wrong_names_are_never_taken_for_stored(spark, folder):
    t = IncrementalTable(spark, f"{folder}/events", _events(spark, [0]).schema, block_bits=12)
    t.load_keyed(_events(spark, range(9), "concat('e', id)"))
    t.load_keyed(_events(spark, range(9)))  # the same places, other events
    assert t.read().count() == 18
