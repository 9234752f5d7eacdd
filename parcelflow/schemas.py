"""Declared schemas and event contracts. Nothing here is ever inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Topic names, and the number of partitions each topic has.
TOPICS = ("orders", "payments", "shipments")
TOPIC_PARTITIONS = 3

# Columns of Spark's Kafka source, in a batch or a stream.
KAFKA_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# The identity of a message: unique over the whole history.
MESSAGE_KEY = ["kafka_topic", "kafka_partition", "kafka_offset"]

RAW_EVENTS = T.StructType(
    [
        T.StructField("kafka_topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("kafka_key", T.StringType()),
        T.StructField("payload", T.VariantType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("ingested_at", T.TimestampType()),
        # whole-number fields written with a point or an exponent, which the payload does not remember; mostly NULL
        T.StructField("spelled", T.MapType(T.StringType(), T.StringType())),
    ]
)

# One audited row per message: stored events, rejected messages and repeats.
EVENT_LOG = T.StructType(
    [
        *[f for f in RAW_EVENTS.fields if f.name != "kafka_topic"],
        T.StructField("copies", T.LongType()),
        T.StructField("redelivery", T.BooleanType()),
        T.StructField("reject_id", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("raw_key", T.BinaryType()),
        T.StructField("raw_value", T.BinaryType()),
        T.StructField("message_ts", T.TimestampType()),
        # the micro-batch that brought the row, NULL for other appends
        T.StructField("owner", T.StringType()),
        # partition folders
        T.StructField("outcome", T.StringType()),
        T.StructField("kafka_topic", T.StringType()),
        T.StructField("offset_block", T.LongType()),
    ]
)
LOG_PARTITIONS = ["outcome", "kafka_topic", "offset_block"]
# Messages, log and tables are Parquet of this codec.
COMPRESSION = "zstd"

RAW_CATEGORIES = "category_id bigint, name string, ingested_at timestamp"
RAW_PRODUCTS = (
    "product_id bigint, name string, price decimal(10,2), ingested_at timestamp, category_id int"
)
RAW_CUSTOMERS = "customer_id bigint, name string, email string, ingested_at timestamp"


@dataclass(frozen=True)
class Field:
    """A payload field: its JSON name, its column, its type, its default."""

    json: str
    column: str
    type: str
    default: object = None


# Field names, types and defaults of the three event contracts.
CONTRACTS: dict[str, tuple[Field, ...]] = {
    "orders": (
        Field("order_id", "order_id", "bigint"),
        Field("customer_id", "customer_id", "bigint"),
        Field("product_id", "product_id", "bigint"),
        Field("quantity", "quantity", "int", 1),
        Field("unit_price", "unit_price", "decimal(10,2)"),
        Field("currency", "currency", "string"),
        Field("timestamp", "order_ts", "timestamp"),
    ),
    "payments": (
        Field("payment_id", "payment_id", "bigint"),
        Field("order_id", "order_id", "bigint"),
        Field("customer_id", "customer_id", "bigint"),
        Field("amount", "amount", "decimal(12,2)"),
        Field("currency", "currency", "string"),
        Field("payment_date", "payment_date", "timestamp"),
    ),
    "shipments": (
        Field("shipment_id", "shipment_id", "bigint"),
        Field("payment_id", "payment_id", "bigint"),
        Field("order_id", "order_id", "bigint"),
        Field("customer_id", "customer_id", "bigint"),
        Field("ship_date", "ship_date", "timestamp"),
    ),
}


def create_if_absent(
    spark: SparkSession, path: str, schema: T.StructType | str, partitions: list[str] | None = None
) -> None:
    """An empty Parquet table at ``path``; no-op when there is one."""
    empty_rows(spark, schema).write.mode("ignore").partitionBy(*(partitions or [])).parquet(path)


def empty_rows(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
