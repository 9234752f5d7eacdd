"""The order -> payment -> shipment chain as two streaming queries.

The queue between two stages is the upstream stage's own output, read with a
checkpoint: in order per partition, nothing lost, nothing handed out twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelflow.functions import decode_key, decode_utf8, spelled_numbers, with_strict_json
from parcelflow.operators.chain import derive_payments, derive_shipments, payment_messages, shipment_messages
from parcelflow.plans.staging import stg_orders, stg_payments
from parcelflow.sources.events import event_sink


def as_raw_events(messages: DataFrame) -> DataFrame:
    """Messages of our own making as raw events, stamped with the message time."""
    parsed = with_strict_json(messages.withColumn("_text", decode_utf8(F.col("value"))), "_text", "payload")
    return parsed.select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        decode_key(F.col("key")).alias("kafka_key"),
        "payload",
        F.col("timestamp").alias("event_ts"),
        F.col("timestamp").alias("ingested_at"),
        spelled_numbers(F.col("_text"), F.col("payload")).alias("spelled"),
    )


def start_payments(raw_events: DataFrame, checkpoint: str, **sink) -> StreamingQuery:
    """Pay every order of a raw event stream, once."""
    return event_sink(payment_messages(derive_payments(stg_orders(raw_events))), checkpoint, **sink)


def start_shipments(payments: DataFrame, checkpoint: str, **sink) -> StreamingQuery:
    """Ship every payment of a message stream, once."""
    staged = stg_payments(as_raw_events(payments))
    return event_sink(shipment_messages(derive_shipments(staged)), checkpoint, **sink)
