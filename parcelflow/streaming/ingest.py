"""Continuous ingest of a message stream into the event log."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelflow.operators.event_log import EventLog
from parcelflow.schemas import create_if_absent

_COUNTS = "owner string, attempt bigint, batch_id bigint, topic string, outcome string, messages bigint"


def batch_counts(spark: SparkSession, counts_path: str) -> DataFrame:
    """``batch_id, topic, outcome, messages`` of the micro-batches so far; of a batch that ran again the last attempt counts."""
    create_if_absent(spark, counts_path, _COUNTS)
    rows = spark.read.schema(_COUNTS).parquet(counts_path)
    last = rows.groupBy("owner").agg(F.max("attempt").alias("attempt"))
    return rows.join(last, ["owner", "attempt"], "left_semi").select("batch_id", "topic", "outcome", "messages")


def stream_ingest(
    messages: DataFrame,
    log: EventLog,
    checkpoint: str,
    clock: Column | None = None,
    counts_path: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Append every micro-batch to the log.

    ``counts_path`` is a table that gets the messages per topic and outcome of each batch, as
    :func:`batch_counts` reads them.

    The checkpoint takes the place of offset commits: offsets count as done
    only after their batch is stored. A batch that runs twice finds its own rows
    in the log, by checkpoint and number, and adds what is missing: delivery and counts are effectively exactly-once.
    The log needs no streaming state: history is looked up in the stored blocks.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        # rereading a broker costs more than a local copy of one bounded batch
        owner = f"{checkpoint.rstrip('/')}#{batch_id}"
        counts = log.append(batch, clock, keep=True, owner=owner)
        if counts_path is not None and counts:
            now = time.time_ns()
            rows = [(owner, now, batch_id, topic, outcome, n) for (topic, outcome), n in counts.items()]
            entry = log.spark.createDataFrame(rows, _COUNTS).coalesce(1)
            entry.write.mode("append").parquet(counts_path)

    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
    return (writer.trigger(**trigger) if trigger else writer).start()
