"""Appending to the event log: uniqueness over all history, and full accounting."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parcelflow.operators import event_log
from parcelflow.operators.event_log import EventLog, quarantine_as_messages
from parcelflow.schemas import KAFKA_SCHEMA, MESSAGE_KEY
from parcelflow.sources.order_tables import kafka_frame
from tests.helpers import frame, message


@pytest.fixture(params=["small batch", "large batch", "large batch, many repeats"])
def way(request, monkeypatch):
    """However a batch is appended, the result is the same."""
    if request.param != "small batch":
        monkeypatch.setattr(event_log, "_SMALL_BATCH", 0)
    if request.param.endswith("repeats"):
        monkeypatch.setattr(event_log, "_BROADCAST_POSITIONS", 0)


def counts(log):
    return {(r["topic"], r["outcome"]): r["messages"] for r in log.outcomes().collect()}


def keys(log):
    return sorted(tuple(r) for r in log.raw_events().select(*MESSAGE_KEY).collect())


def test_repeats_are_counted_and_stored_once(spark, folder, way):
    log = EventLog(spark, folder)
    first = [message("1", offset=5), message("1", offset=5), message("1", offset=6)]
    log.append(frame(spark, *first))
    log.append(frame(spark, message("1", offset=6), message("1", offset=7)))
    assert keys(log) == [("orders", 0, 5), ("orders", 0, 6), ("orders", 0, 7)]
    assert counts(log) == {("orders", "written"): 3, ("orders", "duplicate"): 2}


def test_same_offset_elsewhere_is_no_repeat(spark, folder):
    log = EventLog(spark, folder)
    log.append(frame(spark, message("1"), message("1", partition=1), message("1", topic="payments")))
    log.append(frame(spark, message("1", partition=2)))
    assert len(keys(log)) == 4
    assert not any(outcome == "duplicate" for _, outcome in counts(log))


def test_first_delivery_wins(spark, folder, way):
    log = EventLog(spark, folder)
    log.append(frame(spark, message('"late"', minutes=2), message('"early"', minutes=1)))
    log.append(frame(spark, message('"other"', minutes=0)))
    assert [r[0] for r in log.raw_events().select(F.col("payload").cast("string")).collect()] == ["early"]


def test_a_bad_copy_does_not_take_the_offset(spark, folder):
    log = EventLog(spark, folder)
    log.append(frame(spark, message("{")))
    log.append(frame(spark, message("1")))
    assert keys(log) == [("orders", 0, 0)]
    assert counts(log) == {("orders", "bad"): 1, ("orders", "written"): 1}


def test_redelivered_bad_messages_count_again_but_are_kept_once(spark, folder, way):
    log = EventLog(spark, folder)
    for _ in range(2):
        log.append(frame(spark, message("{"), message("{"), message("[", offset=0)))
    assert counts(log) == {("orders", "bad"): 6}
    assert sorted(bytes(r["raw_value"]) for r in log.quarantine().collect()) == [b"[", b"{"]


def test_ingesting_all_messages_twice_equals_once(spark, tables, folder, way):
    log = EventLog(spark, folder, block_bits=6)
    messages = kafka_frame(spark, tables)
    log.append(messages, F.col("message_ts"))
    once = log.raw_events().withColumn("payload", F.to_json("payload"))
    rows, total = sorted(once.collect()), messages.count()
    assert sum(counts(log).values()) == total
    log.append(messages.orderBy(F.desc("offset")), F.col("message_ts"))
    again = log.raw_events().withColumn("payload", F.to_json("payload"))
    assert sorted(again.collect()) == rows
    assert sum(counts(log).values()) == 2 * total


def test_message_counts_of_the_order_tables(spark, folder):
    log = EventLog(spark, folder)
    log.append(kafka_frame(spark, "/root/testdata/sf0.001"))
    written = {t: n for (t, o), n in counts(log).items() if o == "written"}
    assert written == {"orders": 1500, "payments": 986, "shipments": 493}


def test_empty_batch_changes_nothing(spark, folder):
    log = EventLog(spark, folder)
    log.append(frame(spark, message("1")).limit(0))
    assert keys(log) == []


def test_redrive_of_repaired_messages(spark, folder):
    log = EventLog(spark, folder)
    log.append(frame(spark, message('{"order_id":3}', key=b"\xff"), message("{", offset=1)))
    assert keys(log) == []
    rejected = quarantine_as_messages(log.quarantine().filter("outcome = 'error'"))
    log.redrive(rejected.withColumn("key", F.encode(F.lit("3"), "UTF-8")).select(KAFKA_SCHEMA.fieldNames()))
    assert [(r["kafka_key"], r["kafka_offset"]) for r in log.raw_events().collect()] == [("3", 0)]


def test_repairs_settle_what_they_repair(spark, folder):
    """A second redrive offers nothing that is settled; what is still bad stays open and its attempts are counted."""
    log = EventLog(spark, f"{folder}/log")
    log.append(frame(spark, message("1", key=b"\xff"), message("{", offset=1), message("{", offset=1), message("[", offset=1)))
    assert log.repairs().count() == 0 and log.quarantine().count() == 3

    def offer(value):
        rejected = quarantine_as_messages(log.quarantine()).withColumn("value", F.encode(F.lit(value), "UTF-8"))
        good = rejected.withColumn("key", F.encode(F.lit("7"), "UTF-8")).select(*KAFKA_SCHEMA.fieldNames(), "reject_id")
        return log.redrive(good)

    def letters():
        return sorted((r.kafka_offset, r.reason, r.attempts, r.settled) for r in log.dead_letters().collect())

    assert offer("still {") == {}
    assert offer("still {") == {}  # the same repair again
    assert offer("{") == {}
    wanted = [(0, "key is not utf-8", 2, False), (1, "value is not json", 2, False), (1, "value is not json", 2, False)]
    assert letters() == wanted and log.quarantine().count() == 3 and counts(log)["orders", "bad"] == 3
    assert offer('{"a":1}') == {("orders", "written"): 2, ("orders", "duplicate"): 1}  # both at offset 1 are one event
    assert letters() == [(o, reason, 3, True) for o, reason, _, _ in wanted]
    assert log.quarantine().count() == 0 and offer('{"a":2}') == {}
    assert keys(log) == [("orders", 0, 0), ("orders", 0, 1)]


def test_a_redrive_that_dies_before_its_ledger_is_repeated(spark, folder, monkeypatch):
    log = EventLog(spark, f"{folder}/log")
    log.append(frame(spark, message("1", key=b"\xff")))
    fixed = quarantine_as_messages(log.quarantine()).withColumn("key", F.encode(F.lit("7"), "UTF-8"))
    fixed = spark.createDataFrame(fixed.collect(), fixed.schema)
    ledger, log._ledger = log._ledger, "no-such-scheme://x"
    with pytest.raises(Exception):
        log.redrive(fixed)
    log._ledger = ledger
    assert log.quarantine().count() == 1 and log.raw_events().count() == 1
    log.redrive(fixed)
    assert log.quarantine().count() == 0 and log.raw_events().count() == 1


def test_history_check_opens_only_the_blocks_of_the_batch(spark, folder):
    log = EventLog(spark, folder, block_bits=4)
    log.append(frame(spark, *[message("1", offset=i) for i in range(0, 160, 8)]))
    batch = frame(spark, message("1", offset=40), message("1", offset=41))
    known = log._known(log._spans(batch))
    assert known.select("kafka_offset").collect() == [(40,)]
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "offset_block" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_one_hot_message(spark, folder, way):
    copies = spark.range(20000).selectExpr(
        "encode('7', 'UTF-8') key", "encode(if(id % 3 = 0, '5', string(id)), 'UTF-8') value", "'orders' topic",
        "0 partition", "if(id % 3 = 0, 1L, id + 10) offset", "timestamp '2024-01-01' timestamp",
    )
    log = EventLog(spark, folder)
    log.append(copies)
    assert counts(log) == {("orders", "written"): 13334, ("orders", "duplicate"): 6666}


def opened(df):
    """Folders of stored blocks that a plan reads."""
    return {f.split("/log/")[1].rsplit("/", 1)[0] for f in df.inputFiles()}


def test_history_is_looked_up_per_partition(spark, folder):
    """A partition that lags behind opens its own blocks, not those between it and the others."""
    log = EventLog(spark, f"{folder}/log", block_bits=4)
    log.append(frame(spark, *[message('{"a":1}', offset=o) for o in range(1600)]))
    assert len(opened(log.read())) == 100
    batch = frame(spark, message('{"a":1}', offset=1599), message('{"a":2}', partition=1, offset=0))
    known = log._known(log._spans(batch))
    assert opened(known) == {"outcome=written/kafka_topic=orders/offset_block=99", "outcome=written/kafka_topic=orders/offset_block=0"}
    assert known.count() == 1
    late = frame(spark, message('{"a":2}', partition=1, offset=3))
    assert opened(log._known(log._spans(late))) == {"outcome=written/kafka_topic=orders/offset_block=0"}
    elsewhere = frame(spark, message('{"a":2}', topic="payments"))
    assert opened(log._known(log._spans(elsewhere))) == set()
    assert log.append(batch) == {("orders", "written"): 1, ("orders", "duplicate"): 1}


def test_wide_spans_prune_the_listing_instead(spark, folder, monkeypatch):
    from parcelflow.operators import event_log

    log = EventLog(spark, f"{folder}/log", block_bits=2)
    batch = frame(spark, *[message('{"a":1}', offset=o) for o in range(20)])
    log.append(batch)
    monkeypatch.setattr(event_log, "_NAMED_FOLDERS", 1)
    assert log.append(batch) == {("orders", "duplicate"): 20}


def test_appends_at_the_same_time_store_an_event_once(spark, folder):
    from concurrent.futures import ThreadPoolExecutor

    log, same = EventLog(spark, f"{folder}/log"), EventLog(spark, f"{folder}/log")
    batch = frame(spark, *[message('{"a":1}', offset=o) for o in range(50)])
    with ThreadPoolExecutor(2) as pool:
        counts = [job.result() for job in [pool.submit(x.append, batch) for x in (log, same)]]
    assert sorted(counts, key=str) == [{("orders", "duplicate"): 50}, {("orders", "written"): 50}]
    assert log.raw_events().count() == 50


def test_counts_of_an_append(spark, folder):
    log = EventLog(spark, folder)
    batch = frame(spark, message('{"a":1}'), message('{"a":1}'), message("nope", offset=5), message('{"a":1}', key=b"\xff", offset=6), message('{"a":1}', topic="x"))
    assert log.append(batch) == {
        ("orders", "written"): 1, ("orders", "duplicate"): 1, ("orders", "bad"): 1, ("orders", "error"): 1, ("x", "written"): 1,
    }
    assert log.append(batch.limit(0)) == {}


def test_a_topic_is_read_from_its_folder(spark, folder):
    log = EventLog(spark, f"{folder}/log")
    log.append(frame(spark, message('{"a":1}'), message('{"a":2}', topic="payments"), message("bad", topic="payments", offset=1)))
    rows = log.raw_events(blocks=True, topic="payments")
    assert opened(rows) == {"outcome=written/kafka_topic=payments/offset_block=0"} and rows.count() == 1
    assert log.raw_events(topic="shipments").count() == 0
    assert rows.columns == log.raw_events(blocks=True).columns


def _batch(spark, rows: int, first: int = 0):
    return spark.range(first, first + rows).selectExpr(
        "encode(string(id), 'UTF-8') key", "encode(concat('{\"order_id\":', id, '}'), 'UTF-8') value",
        "'orders' topic", "cast(id % 3 as int) partition", "id div 3 offset", "timestamp_seconds(id) timestamp",
    )


def test_many_repeats_do_not_send_the_batch_through_a_shuffle(spark, folder, monkeypatch):
    monkeypatch.setattr(event_log, "_SMALL_BATCH", 0)
    monkeypatch.setattr(event_log, "_BROADCAST_POSITIONS", 10)
    ways = []
    fresh = event_log.fresh_rows
    monkeypatch.setattr(event_log, "fresh_rows", lambda *args: ways.append("fresh") or fresh(*args))
    log = EventLog(spark, f"{folder}/log")
    batch = _batch(spark, 3000)
    assert log.append(batch.unionAll(_batch(spark, 900))) == {("orders", "written"): 3000, ("orders", "duplicate"): 900}
    assert log.append(batch) == {("orders", "duplicate"): 3000}  # all of them are in the log
    assert ways == ["fresh"] * 2
    assert log.raw_events().filter("variant_get(payload, '$.order_id', 'bigint') = kafka_offset * 3 + kafka_partition").count() == 3000


def test_large_batches_store_what_small_ones_store(spark, folder, monkeypatch):
    offsets = [-1025, -64, -1, 0, 63, 64, 1023, 1024, (1 << 40) + 7, None]
    texts = ['{"order_id":1}', "no json", None, '{"order_id":2}']

    def batch(some, order: int):
        found = [message(t, offset=o, partition=p, minutes=m) for m, t in enumerate(some) for o in offsets for p in (0, 1, None)]
        return frame(spark, *found[::order])

    def stored(size: int):
        monkeypatch.setattr(event_log, "_SMALL_BATCH", size)
        log = EventLog(spark, f"{folder}/log-{size}")
        counts = [log.append(b, F.col("message_ts")) for b in (batch(texts[1:], 1), batch(texts, -1), batch(texts[:2], 2), batch(texts, 1))]
        rows = log.read().withColumns({"payload": F.to_json("payload"), "spelled": F.to_json("spelled")})
        return counts, sorted(map(str, rows.collect()))

    assert stored(0) == stored(10**6)


def test_messages_that_only_repeat_a_stored_event_are_not_merged(spark, folder, monkeypatch):
    monkeypatch.setattr(event_log, "_SMALL_BATCH", 0)
    merged, log_rows = [], event_log.log_rows
    monkeypatch.setattr(event_log, "log_rows", lambda frame, known, *args, **more: merged.append((frame, known)) or log_rows(frame, known, *args, **more))
    log = EventLog(spark, f"{folder}/log")
    log.append(_batch(spark, 900).unionAll(frame(spark, message("no json", offset=5))))
    # offset 5 of partition 0 holds a rejected message beside the event, and two events come twice
    assert log.append(_batch(spark, 1000).unionAll(_batch(spark, 2))) == {("orders", "written"): 100, ("orders", "duplicate"): 902}
    again, known = merged[-1]
    assert (again.count(), known.count()) == (5, 4)
    assert log.append(frame(spark, message("no json", offset=7), message("no json", offset=5))) == {("orders", "bad"): 2}
    assert log.quarantine().select("kafka_offset").orderBy("kafka_offset").collect() == [(5,), (7,)]
