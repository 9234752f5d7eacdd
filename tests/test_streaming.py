"""Streams equal batches, over several micro-batches and restarts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parcelflow.operators.event_log import EventLog
from parcelflow.plans import staging
from parcelflow.queries import raw
from parcelflow.schemas import MESSAGE_KEY
from parcelflow.sources.events import event_source, write_events
from parcelflow.sources.logs import log_scan, parse_lines
from parcelflow.sources.order_tables import kafka_frame
from parcelflow.streaming.chain import as_raw_events, start_payments, start_shipments
from parcelflow.streaming.enrich import LateEvents, enrich_payments, late_events
from parcelflow.streaming.ingest import batch_counts, stream_ingest


def run(query):
    query.awaitTermination()
    return [p for p in query.recentProgress if p["numInputRows"] > 0]


def stored(log):
    return sorted(tuple(r) for r in log.raw_events().select(*MESSAGE_KEY).collect())


def test_ingest_with_restart_and_replay(spark, tables, folder):
    messages = kafka_frame(spark, tables)
    first, second = messages.randomSplit([0.5, 0.5], seed=1)
    write_events(first.repartition(3), path=f"{folder}/topic")
    log = EventLog(spark, f"{folder}/log")

    def ingest(checkpoint):
        source = event_source(spark, path=f"{folder}/topic", maxFilesPerTrigger="2")
        return run(stream_ingest(source, log, f"{folder}/{checkpoint}", F.col("message_ts"), availableNow=True))

    assert len(ingest("cp")) == 2
    write_events(second.repartition(3), path=f"{folder}/topic")
    assert len(ingest("cp")) == 2  # resumes: only the new files
    batch = EventLog(spark, f"{folder}/batch")
    batch.append(messages, F.col("message_ts"))
    assert stored(log) == stored(batch)
    assert sorted(log.outcomes().collect()) == sorted(batch.outcomes().collect())
    ingest("lost checkpoint")  # everything is delivered again
    assert stored(log) == stored(batch)


def test_topics_are_selected(spark, tables, folder):
    write_events(kafka_frame(spark, tables), path=folder)
    topics = event_source(spark, ("payments",), path=folder, streaming=False).select("topic").distinct().collect()
    assert topics == [("payments",)]
    with pytest.raises(ValueError):
        event_source(spark)


def test_chain_derives_each_event_once_across_restarts(spark, tables, folder):
    log = EventLog(spark, f"{folder}/log")
    halves = kafka_frame(spark, tables).randomSplit([0.5, 0.5], seed=2)
    for half in halves:
        log.append(half, F.col("message_ts"))
        run(start_payments(log.stream(), f"{folder}/cp1", path=f"{folder}/payments", availableNow=True))
        paid = event_source(spark, ("payments",), path=f"{folder}/payments")
        run(start_shipments(paid, f"{folder}/cp2", path=f"{folder}/shipments", availableNow=True))
    orders = staging.stg_orders(log.raw_events())
    shipped = staging.stg_shipments(
        as_raw_events(event_source(spark, ("shipments",), path=f"{folder}/shipments", streaming=False))
    )
    assert shipped.count() == orders.count() == 1500
    assert shipped.select("shipment_id").distinct().count() == 1500
    assert shipped.select("kafka_key").exceptAll(orders.select("kafka_key")).isEmpty()


@pytest.mark.parametrize("hot", [[], [(4, 3), (5, 2), (5, 4), (10**9, 7), (7, 0)]])
def test_enrichment_over_several_batches(spark, folder, hot):
    def events(first, count):
        return spark.range(first, first + count).selectExpr("id", "timestamp_seconds(id * 3600) at")

    def write(step, first, count):
        rows = events(first, count)
        rows.selectExpr("id order_id", "id product_id", "1 quantity", "cast(2 as decimal(10,2)) unit_price",
                        "at order_ts").write.parquet(f"{folder}/orders/step={step}")
        # every third payment names an order that does not exist, or none
        rows.selectExpr("id payment_id", "case when id % 6 = 0 then null when id % 3 = 0 then -id else id end order_id", "cast(2 as decimal(12,2)) amount",
                        "'EUR' currency", "at + interval 1 hour payment_date").write.parquet(f"{folder}/payments/step={step}")

    def stream(name):
        schema = spark.read.parquet(f"{folder}/{name}").schema
        return spark.readStream.schema(schema).parquet(f"{folder}/{name}")

    for step, (first, count) in enumerate([(0, 100), (100, 100), (200, 100)]):
        write(step, first, count)
        query = enrich_payments(stream("payments"), stream("orders"), max_delay="2 hours", late="1 hour", hot_orders=hot)
        writer = query.writeStream.option("checkpointLocation", f"{folder}/cp").outputMode("append")
        run(writer.trigger(availableNow=True).format("parquet").start(f"{folder}/out"))
    rows = spark.read.parquet(f"{folder}/out")
    assert rows.filter("product_id IS NOT NULL").count() == 200
    bare = {r["payment_id"] for r in rows.filter("product_id IS NULL").collect()}
    assert bare <= set(range(0, 300, 3)) and len(bare) >= 95  # the newest wait for the watermark
    assert rows.count() == rows.select("payment_id").distinct().count()


def test_late_events_are_counted(spark, folder):
    def stream(name, rows, step):
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/{name}/step={step}")
        return spark.readStream.schema(rows.schema).parquet(f"{folder}/{name}")

    def payments(ids, day):
        return spark.createDataFrame([(i, i, 1, "EUR") for i in ids], "payment_id long, order_id long, amount int, currency string").selectExpr(
            "*", f"timestamp '2024-01-{day}' payment_date")

    def orders(ids, day):
        return spark.createDataFrame([(i, 1, 1, 1) for i in ids], "order_id long, product_id long, quantity int, unit_price int").selectExpr(
            "*", f"timestamp '2024-01-{day}' order_ts")

    dropped = []
    for step, day in enumerate(["10", "20", "02"]):
        rows = payments([step], day), orders([step], day)
        query = enrich_payments(stream("p", rows[0], step), stream("o", rows[1], step), max_delay="1 day")
        query = query.writeStream.option("checkpointLocation", f"{folder}/cp").outputMode("append")
        query = query.trigger(availableNow=True).format("parquet").start(f"{folder}/out")
        query.awaitTermination()
        dropped.append(late_events(query))
    assert dropped == [0, 0, 2]  # the last pair is more than a day behind the newest
    with pytest.raises(ValueError):
        enrich_payments(*rows, hot_orders=[(i, 2) for i in range(1001)])


def test_batch_counters_add_up_to_the_outcomes(spark, tables, folder):
    write_events(kafka_frame(spark, tables).repartition(4), path=f"{folder}/topic")
    log = EventLog(spark, f"{folder}/log")
    source = event_source(spark, path=f"{folder}/topic", maxFilesPerTrigger="2")
    progress = run(stream_ingest(source, log, f"{folder}/cp", F.col("message_ts"), f"{folder}/counts", availableNow=True))
    counts = batch_counts(spark, f"{folder}/counts")
    assert counts.select("batch_id").distinct().count() == len(progress) == 2
    total = counts.groupBy("topic", "outcome").agg(F.sum("messages").alias("messages"))
    assert sorted(map(tuple, total.collect())) == sorted(map(tuple, log.outcomes().collect()))
    assert batch_counts(spark, f"{folder}/none").count() == 0


@pytest.mark.parametrize("large", [False, True])
def test_a_batch_that_runs_again_counts_once(spark, tables, folder, monkeypatch, large):
    """Lost before its counters were written, or before the checkpoint: the same rows and counts as running once."""
    from parcelflow.operators import event_log

    if large:
        monkeypatch.setattr(event_log, "_SMALL_BATCH", 0)
    messages = kafka_frame(spark, tables).filter("offset % 3 <> 1 or offset >= 10000000")
    log, once = EventLog(spark, f"{folder}/log"), EventLog(spark, f"{folder}/once")
    for each in (log, once):
        each.append(messages.filter("offset % 5 = 0"), F.col("message_ts"))  # history that the batch repeats
    wanted = once.append(messages, F.col("message_ts"))
    for _ in range(2):
        assert log.append(messages, F.col("message_ts"), owner="cp#0") == wanted
    assert sorted(map(tuple, log.outcomes().collect())) == sorted(map(tuple, once.outcomes().collect()))
    assert log.read().count() == once.read().count()
    assert log.append(messages, F.col("message_ts"), owner="cp#1") != wanted  # another batch: all duplicates


def test_counters_of_a_repeated_batch(spark, folder):
    rows = [("cp#0", 1, 0, "orders", "written", 5), ("cp#0", 2, 0, "orders", "written", 5), ("cp#1", 1, 1, "orders", "bad", 2)]
    schema = "owner string, attempt bigint, batch_id bigint, topic string, outcome string, messages bigint"
    for row in rows:
        spark.createDataFrame([row], schema).write.mode("append").parquet(folder)
    assert sorted(map(tuple, batch_counts(spark, folder).collect())) == [(0, "orders", "written", 5), (1, "orders", "bad", 2)]


def test_late_events_are_counted_over_the_whole_run(spark, folder):
    """Twelve micro-batches with a drop early on, and only the last two reports kept."""
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    counter = LateEvents()
    spark.streams.addListener(counter)
    spark.conf.set(kept, "2")
    try:
        for i in range(12):
            day = "02" if i in (3, 4) else f"{10 + i}"
            paid = spark.createDataFrame([(i, i, 1, "EUR")], "payment_id long, order_id long, amount int, currency string")
            paid = paid.selectExpr("*", f"timestamp '2024-01-{day}' payment_date")
            placed = spark.createDataFrame([(-1, 1, 1, 1)], "order_id long, product_id long, quantity int, unit_price int")
            placed = placed.selectExpr("*", f"timestamp '2024-01-{10 + i}' order_ts")
            paid.coalesce(1).write.mode("append").parquet(f"{folder}/p")
            placed.coalesce(1).write.mode("append").parquet(f"{folder}/o")
        streams = [
            spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(f"{folder}/{name}")
            for name, rows in (("p", paid), ("o", placed))
        ]
        query = enrich_payments(*streams, max_delay="1 day").writeStream.option("checkpointLocation", f"{folder}/cp")
        query = query.outputMode("append").trigger(availableNow=True).format("parquet").start(f"{folder}/out")
        query.awaitTermination()
        assert counter.of(query) == 2
        assert late_events(query) == 0
    finally:
        spark.conf.set(kept, before)
        spark.streams.removeListener(counter)


def test_a_batch_read_of_a_broker_needs_a_fixed_end(spark):
    for options in ({}, {"endingOffsets": "latest"}):
        with pytest.raises(ValueError, match="endingOffsets"):
            event_source(spark, servers="broker:9092", streaming=False, **options)


def test_staging_works_on_a_stream(spark, tables, folder):
    log = EventLog(spark, f"{folder}/log")
    log.append(kafka_frame(spark, tables), F.col("message_ts"))
    query = staging.stg_orders(log.stream()).writeStream.option("checkpointLocation", f"{folder}/cp")
    run(query.trigger(availableNow=True).format("parquet").start(f"{folder}/out"))
    expected = staging.stg_orders(raw(spark, tables))
    assert spark.read.parquet(f"{folder}/out").exceptAll(expected).isEmpty()


def test_log_lines(spark):
    lines = ["2024-01-02 03:04:05 | INFO     | api | ready | steady", "Traceback (most recent call last):", "x | y | z | w", ""]
    rows = spark.createDataFrame([(i, t, f"/logs/{f}/2024-01-02.log") for i, (t, f) in enumerate(
        zip(lines, ["api", "kafka_consumer", "kafka_producer_orders", "elsewhere"], strict=True))], "i int, value string, path string")
    found = parse_lines(rows).collect()
    assert [(r["level"], r["logger"], r["message"]) for r in found] == [("INFO", "api", "ready | steady")] + [(None,) * 3] * 3
    assert [r["job"] for r in found] == ["api", "kafka_consumer", "kafka_producer", None]
    assert str(found[0]["ts"]) == "2024-01-02 03:04:05" and found[1]["ts"] is None
    assert [r["line"] for r in found] == lines


def test_log_files_as_a_stream(spark, folder):
    spark.createDataFrame([("2024-01-02 03:04:05 | ERROR    | api | down",)], "value string").write.text(f"{folder}/logs/api")
    query = log_scan(spark, f"{folder}/logs", streaming=True).writeStream.option("checkpointLocation", f"{folder}/cp")
    run(query.trigger(availableNow=True).format("parquet").start(f"{folder}/out"))
    assert [(r["level"], r["job"]) for r in spark.read.parquet(f"{folder}/out").collect()] == [("ERROR", "api")]
