"""Downstream events derived from upstream events: order -> payment -> shipment.

Stateless projections, the same on a batch and on a stream. Each input event
yields exactly one output event, whose id follows from the input's position,
so a replay derives the same event again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import iso_text
from parcelflow.sources.events import encode_events

# Room for 2**20 partitions; the offset fills the bits above.
_PARTITION_BITS = 20


def derived_id() -> Column:
    """A number unique to the (partition, offset) of the upstream event."""
    return F.shiftleft("kafka_offset", _PARTITION_BITS) + F.col("kafka_partition")


def derive_payments(orders: DataFrame) -> DataFrame:
    """One payment per staged order, for the exact product of quantity and price."""
    return orders.select(
        derived_id().alias("payment_id"),
        "order_id",
        "customer_id",
        (F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)").alias("amount"),
        "currency",
        F.col("ingested_at").alias("payment_date"),
        "kafka_partition",
        "kafka_offset",
    )


def derive_shipments(payments: DataFrame) -> DataFrame:
    """One shipment per staged payment."""
    return payments.select(
        derived_id().alias("shipment_id"),
        "payment_id",
        "order_id",
        "customer_id",
        F.col("ingested_at").alias("ship_date"),
        "kafka_partition",
        "kafka_offset",
    )


def _position(at: str) -> list[Column]:
    # A broker assigns these itself; in files the derived event keeps its parent's place.
    return [
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col(at).alias("timestamp"),
    ]


def payment_messages(payments: DataFrame) -> DataFrame:
    """Derived payments in the Kafka shape."""
    fields = [
        "payment_id", "order_id", "customer_id", "amount", "currency",
        iso_text(F.col("payment_date")).alias("payment_date"),
    ]
    return encode_events(payments, "payments", "order_id", fields, *_position("payment_date"))


def shipment_messages(shipments: DataFrame) -> DataFrame:
    """Derived shipments in the Kafka shape."""
    fields = [
        "shipment_id", "payment_id", "order_id", "customer_id",
        iso_text(F.col("ship_date")).alias("ship_date"),
    ]
    return encode_events(shipments, "shipments", "order_id", fields, *_position("ship_date"))


def order_messages(orders: DataFrame) -> DataFrame:
    """Staged orders back in the Kafka shape."""
    fields = [
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "currency",
        iso_text(F.col("order_ts")).alias("timestamp"),
    ]
    return encode_events(orders, "orders", "order_id", fields, *_position("order_ts"))
