"""The stored event log: append with history check, and its readable views."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from parcelflow.functions.keys import BLOCK_BITS
from parcelflow.operators.ingest import classify, fresh_rows, log_rows, outcome_counts
from parcelflow.operators.positions import bit_pages, page_of, with_flags
from parcelflow.schemas import COMPRESSION, EVENT_LOG, KAFKA_SCHEMA, LOG_PARTITIONS, MESSAGE_KEY, RAW_EVENTS, create_if_absent, empty_rows

# A message's place, by the columns of the Kafka source.
_POSITION = ["topic", "partition", "offset"]
# Up to this many messages one shuffle costs less than a pass to avoid it.
_SMALL_BATCH = 1_000_000
# Repeated positions are broadcast as a bit each, in pages of 1024 consecutive offsets: up to so many pages (some 200 MB).
_BROADCAST_POSITIONS = 1_000_000
# What the bits tell of a position: it is repeated; the log holds an event there; that event is all it repeats.
_FLAGS = ["_again", "_held", "_lone"]
# A task may write into this many blocks; beyond it rows are gathered by block first, unless there are many for each file.
_FILES_PER_TASK = 32
_ROWS_PER_FILE = 4_000
# History is looked up by naming up to this many folders, beyond it by pruning the whole listing; the rows are the same.
_NAMED_FOLDERS = 10_000
_OUTCOMES = ("written", "duplicate", "bad", "error")

# A rejected message, and the ledger of what was offered in its place.
_REJECTED = [*MESSAGE_KEY, "reject_id"]
_REPAIRS = "kafka_topic string, kafka_partition int, kafka_offset bigint, reject_id string, repair_id bigint, accepted boolean"

# Appends of one driver to one log wait for each other; a log has one writing application.
_LOCKS: dict[str, threading.Lock] = defaultdict(threading.Lock)

# (topic, outcome) -> messages of an append
Counts = dict[tuple[str, str], int]


class EventLog:
    """Parquet, partitioned by outcome, topic and offset block.

    Topic filters prune folders, and the uniqueness check against all history
    opens only the blocks a batch touches.
    """

    def __init__(self, spark: SparkSession, path: str, block_bits: int = BLOCK_BITS):
        self.spark, self.path, self.block_bits = spark, path, block_bits
        self._ledger = f"{path.rstrip('/')}-repairs"
        create_if_absent(spark, path, EVENT_LOG, LOG_PARTITIONS)

    def read(self) -> DataFrame:
        return self.spark.read.schema(EVENT_LOG).parquet(self.path)

    def raw_events(self, blocks: bool = False, topic: str | None = None) -> DataFrame:
        """The stored events, one per (topic, partition, offset).

        ``blocks`` adds their folder, ``offset_block``, for incremental loads. With ``topic`` only
        that topic's folder is listed.
        """
        columns = RAW_EVENTS.fieldNames() + (["offset_block"] if blocks else [])
        if topic is None:
            return self.read().filter(F.col("outcome") == "written").select(columns)
        return self._folders([f"outcome=written/kafka_topic={topic}"]).select(columns)

    def quarantine(self) -> DataFrame:
        """Rejected messages that no repair has settled, with their reason and original bytes."""
        rejected = self._rejected()
        settled = self.repairs().filter("accepted").select(*_REJECTED).distinct()
        return rejected.join(settled, _REJECTED, "left_anti").select(
            *MESSAGE_KEY, "outcome", "reason", "raw_key", "raw_value", "message_ts", "ingested_at", "reject_id"
        )

    def dead_letters(self) -> DataFrame:
        """Every rejected message: its reason, how many different repairs were offered, and whether one was accepted."""
        tried = self.repairs().groupBy(*_REJECTED).agg(
            F.count_distinct("repair_id").alias("attempts"), F.max("accepted").alias("settled")
        )
        known = self._rejected().select(*_REJECTED, "outcome", "reason").join(tried, _REJECTED, "left")
        return known.withColumns(
            {"attempts": F.coalesce("attempts", F.lit(0).cast("bigint")), "settled": F.coalesce("settled", F.lit(False))}
        )

    def repairs(self) -> DataFrame:
        """The ledger of repairs offered; a repair that was recorded twice is one by its ``repair_id``."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._ledger)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return empty_rows(self.spark, _REPAIRS)
        return self.spark.read.schema(_REPAIRS).parquet(self._ledger)

    def _rejected(self) -> DataFrame:
        return self.read().filter(F.col("outcome").isin("bad", "error") & ~F.col("redelivery"))

    def outcomes(self) -> DataFrame:
        return outcome_counts(self.read())

    def stream(self, **options: str) -> DataFrame:
        """Stored events as a stream, each row delivered once per checkpoint."""
        reader = self.spark.readStream.schema(EVENT_LOG)
        for name, value in options.items():
            reader = reader.option(name, value)
        rows = reader.parquet(self.path).filter(F.col("outcome") == "written")
        return rows.select(RAW_EVENTS.fieldNames())

    def append(
        self, frame: DataFrame, clock: Column | None = None, keep: bool = False, owner: str | None = None
    ) -> Counts:
        """Add a batch; returns its messages per topic and outcome. Running the same batch again stores no event twice.

        Without ``owner``, messages delivered again count as duplicates. ``owner`` names the batch: another run of it finds the
        rows that its earlier run stored, adds only what is missing, and returns the same counts.

        A small batch is merged in one shuffle. For a large one, a pass over the
        positions alone finds the repeated messages first; all others are parsed
        and written where they lie, so their payloads are never shuffled. Nor are those of messages that the log holds.
        ``keep`` holds the batch on local disk between the passes, for sources
        that are slow to reread. A batch is read more than once, so it must not change in between.
        """
        batch = frame.persist() if keep else frame
        try:
            with _LOCKS[self.path]:
                spans = self._spans(batch)
                if not spans:
                    return {}
                known = self._known(spans, owner)
                bits = self.block_bits
                blocks = sum((s["high"] >> bits) - (s["low"] >> bits) + 1 for s in spans)
                topics = sorted({s["topic"] for s in spans})
                if sum(s["rows"] for s in spans) <= _SMALL_BATCH:
                    return self._write(log_rows(batch, known, clock, bits), blocks, topics, owner)
                return self._append_large(batch, spans, blocks, known, clock, topics, owner)
        finally:
            if keep:
                batch.unpersist()

    def _append_large(
        self,
        batch: DataFrame,
        spans: list[Row],
        blocks: int,
        known: DataFrame,
        clock: Column | None,
        topics: list[str],
        owner: str | None,
    ) -> Counts:
        if known.isEmpty():
            known = None
        files = sum(s["files"] for s in spans) / max(s["tasks"] for s in spans)
        if sum(s["rows"] for s in spans) >= _ROWS_PER_FILE * sum(s["files"] for s in spans):
            files = 0  # large files, however many
        pages = _pages(self._repeated(batch, known)).persist()
        try:
            if pages.count() > _BROADCAST_POSITIONS:
                return self._write(log_rows(batch, known, clock, self.block_bits), files, topics, owner)
            marked = _marked(batch, pages)
            if known is None:
                rows, again = fresh_rows(marked.filter("not _again"), clock, self.block_bits), marked.filter("_again")
            else:
                rows = fresh_rows(marked.filter("not _again or _lone"), clock, self.block_bits, "_lone")
                again = marked.filter("_again and not _lone")
                stored = with_flags(known, pages, MESSAGE_KEY, ["_again", "_lone"])
                known = stored.filter("_again and not _lone").drop("_again", "_lone")
            merged = log_rows(again, known, clock, self.block_bits, held="_held")
            return self._write(rows.unionAll(merged), files, topics, owner)
        finally:
            pages.unpersist()

    def _write(self, rows: DataFrame, files_per_task: float, topics: list[str], owner: str | None) -> Counts:
        if owner is not None:
            rows = rows.withColumn("owner", F.lit(owner))
        if files_per_task > _FILES_PER_TASK:
            # gather blocks first: else every task would leave a small file in each
            rows = rows.hint("rebalance", *LOG_PARTITIONS)
        cells = [(t, o) for t in topics for o in _OUTCOMES]

        def messages(topic: str, outcome: str) -> Column:
            here = (F.col("kafka_topic") == topic) & (F.col("outcome") == outcome)
            return F.sum(F.when(here, F.col("copies")).otherwise(0))

        seen = Observation()  # counted while writing, by the tasks that succeed
        rows = rows.observe(seen, *[messages(t, o).alias(f"c{i}") for i, (t, o) in enumerate(cells)])
        rows = rows.filter(~F.col("stored")).drop("stored")  # an earlier run of the batch left those
        rows.write.mode("append").option("compression", COMPRESSION).partitionBy(*LOG_PARTITIONS).parquet(self.path)
        counts = seen.get
        return {cell: counts[f"c{i}"] for i, cell in enumerate(cells) if counts[f"c{i}"]}

    def _spans(self, batch: DataFrame) -> list[Row]:
        """Offsets covered per topic and partition, and how they lie in the input: one row each.

        ``files`` is the number of blocks its tasks would write to, in all, and ``tasks`` how many tasks hold it.
        """
        block = F.shiftright("offset", self.block_bits)
        return (
            batch.groupBy("topic", "partition", F.spark_partition_id().alias("task"), block.alias("block"))
            .agg(F.min("offset").alias("low"), F.max("offset").alias("high"), F.count(F.lit(1)).alias("rows"))
            .groupBy("topic", "partition")
            .agg(
                F.sum("rows").alias("rows"),
                F.min("low").alias("low"),
                F.max("high").alias("high"),
                F.count(F.lit(1)).alias("files"),
                F.count_distinct("task").alias("tasks"),
            )
            .collect()
        )

    def _repeated(self, batch: DataFrame, known: DataFrame | None) -> DataFrame:
        """Positions that occur twice in the batch, or in the batch and the log.

        ``_held`` tells that the log holds an event there, ``_lone`` that the batch has but one message for it besides, and that the log
        holds no rejected message there and no row of an earlier run of the batch.

        Only positions are shuffled, combined map-side: a message delivered very
        often is no hot spot.
        """
        none = [F.lit(False).alias(c) for c in ("stored", "held", "other")]
        positions = batch.select(*_POSITION, F.lit(1).alias("n"), *none)
        if known is not None:
            place = [F.col(k).alias(p) for k, p in zip(MESSAGE_KEY, _POSITION, strict=True)]
            first = ~F.col("redelivery")
            other = F.col("own") | F.col("outcome").isin("bad", "error")
            positions = positions.unionAll(known.select(*place, F.lit(0), first, first & (F.col("outcome") == "written"), other))
        counted = positions.groupBy(*_POSITION).agg(F.sum("n").alias("n"), *[F.max(c).alias(c) for c in ("stored", "held", "other")])
        repeated = counted.filter((F.col("n") > 1) | ((F.col("n") == 1) & F.col("stored")))
        lone = (F.col("n") == 1) & F.col("held") & ~F.col("other")
        return repeated.select(*_POSITION, F.col("held").alias("_held"), lone.alias("_lone"))

    def _known(self, spans: list[Row], owner: str | None = None) -> DataFrame:
        """Stored identities that could collide with a batch; ``own`` ones are of an earlier run of it, repeats included.

        Offsets only collide within one partition of a topic, and there within the batch's own span. So the
        folders of those blocks are named, not found by listing all history, and
        the spans become literal filters on the Parquet statistics of ``kafka_offset``.
        """
        stored = self._blocks(spans)
        tests = [
            (F.col("kafka_topic") == s["topic"])
            & (F.col("kafka_partition") == s["partition"])
            & F.col("offset_block").between(s["low"] >> self.block_bits, s["high"] >> self.block_bits)
            & F.col("kafka_offset").between(s["low"], s["high"])
            for s in spans
        ]
        own = F.lit(False) if owner is None else F.col("owner").eqNullSafe(F.lit(owner))
        stored = stored.filter(~F.col("redelivery") | own).filter(reduce(lambda a, b: a | b, tests))
        return stored.select(*MESSAGE_KEY, "outcome", "reject_id", "redelivery", own.alias("own"))

    def _blocks(self, spans: list[Row]) -> DataFrame:
        """The stored rows in the blocks that the spans touch."""
        wanted: dict[str, set[int]] = defaultdict(set)
        if sum((s["high"] >> self.block_bits) - (s["low"] >> self.block_bits) + 1 for s in spans) > _NAMED_FOLDERS:
            touched = [
                (F.col("kafka_topic") == s["topic"])
                & F.col("offset_block").between(s["low"] >> self.block_bits, s["high"] >> self.block_bits)
                for s in spans
            ]
            return self.read().filter(reduce(lambda a, b: a | b, touched))
        for s in spans:
            wanted[s["topic"]].update(range(s["low"] >> self.block_bits, (s["high"] >> self.block_bits) + 1))
        return self._folders(
            f"outcome=*/kafka_topic={topic}/offset_block={{{','.join(map(str, sorted(blocks)))}}}"
            for topic, blocks in wanted.items()
        )

    def _folders(self, patterns: Iterable[str]) -> DataFrame:
        """The stored rows in the folders that match; the rest of the log is not listed."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        fs = hadoop.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        paths = []
        for pattern in patterns:
            paths += [str(found.getPath()) for found in fs.globStatus(hadoop.Path(f"{self.path}/{pattern}")) or []]
        if not paths:
            return empty_rows(self.spark, EVENT_LOG)
        return self.spark.read.schema(EVENT_LOG).option("basePath", self.path).parquet(*paths)

    def redrive(self, repaired: DataFrame, clock: Column | None = None) -> Counts:
        """Offer repaired quarantine messages (Kafka-shaped, with their ``reject_id``) to ingest again.

        What is sound now goes into the log, and the ledger settles the rejected message: it is not offered again.
        What is still bad stays open, is not stored a second time, and counts as an attempt. The log comes first and the ledger
        after it; a redrive that died in between, or is repeated, stores no event twice and adds no attempt.
        Messages without ``reject_id`` are appended like any others.
        """
        if "reject_id" not in repaired.columns:
            return self.append(repaired, clock)
        offered = ("_offered_for", "key", "value", *_POSITION, "timestamp")
        judged = classify(repaired.withColumn("_offered_for", F.col("reject_id")), keep=offered).persist()
        accepted = F.col("outcome") == "written"
        repair = F.when(accepted, F.xxhash64("kafka_key", "_value_hash")).otherwise(F.xxhash64("reject_id"))
        entries = judged.select(
            *MESSAGE_KEY, F.col("_offered_for").alias("reject_id"), repair.alias("repair_id"), accepted.alias("accepted")
        )
        try:  # one reading of the repairs decides for the log and the ledger
            counts = self.append(judged.filter(accepted).select(KAFKA_SCHEMA.fieldNames()), clock)
            entries.distinct().write.mode("append").parquet(self._ledger)
        finally:
            judged.unpersist()
        return counts


def _pages(positions: DataFrame) -> DataFrame:
    """A row per topic, partition and page: the bits of the positions in it, and of those with each flag."""
    # every position occurs once here, so a page has at most as many rows as bits
    dealt = positions.repartition("topic", "partition", page_of("offset"))
    return bit_pages(dealt.withColumn("_again", F.lit(True)), _POSITION, _FLAGS)


def _marked(batch: DataFrame, pages: DataFrame) -> DataFrame:
    """The batch with ``_again`` for messages whose position is in the pages, and the other flags of that position.

    A message without a position is merged with its like, as in a small batch.
    """
    nowhere = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in _POSITION])
    return with_flags(batch, pages, _POSITION, _FLAGS).withColumn("_again", F.col("_again") | nowhere)


def quarantine_as_messages(quarantine: DataFrame) -> DataFrame:
    """Quarantined rows back in the Kafka shape, ready to be repaired; ``reject_id`` names what a repair is for."""
    return quarantine.select(
        F.col("raw_key").alias("key"),
        F.col("raw_value").alias("value"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("message_ts").alias("timestamp"),
        "reject_id",
    )
