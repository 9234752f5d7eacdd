"""Event streams in the Kafka shape: read, encode and write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelflow.functions import encode_event, partition_of_key
from parcelflow.schemas import COMPRESSION, KAFKA_SCHEMA, TOPICS


def event_source(
    spark: SparkSession,
    topics: tuple[str, ...] = TOPICS,
    servers: str | None = None,
    path: str | None = None,
    streaming: bool = True,
    starting: str = "earliest",
    **options: str,
) -> DataFrame:
    """Messages of ``topics`` from a broker, or from Parquet of the same columns.

    A streaming query resumes from its checkpoint; ``starting`` counts only
    the first time. Reading a broker needs Spark's Kafka connector package. A batch read is read several times by
    whoever uses it, so ``endingOffsets`` must name offsets: "latest" would be another place each time.
    """
    if servers is not None and not streaming and options.get("endingOffsets", "latest") == "latest":
        raise ValueError("a batch read of a broker needs endingOffsets as offsets, not 'latest'")
    reader = spark.readStream if streaming else spark.read
    if servers is not None:
        options = {
            "kafka.bootstrap.servers": servers,
            "subscribe": ",".join(topics),
            "startingOffsets": starting,
            **options,
        }
        frame = reader.format("kafka").options(**options).load()
        return frame.select(KAFKA_SCHEMA.fieldNames())
    if path is None:
        raise ValueError("give either servers or path")
    frame = reader.schema(KAFKA_SCHEMA).options(**options).parquet(path)
    return frame.filter(F.col("topic").isin(*topics))


def encode_events(
    df: DataFrame, topic: str, key: str, fields: list[Column | str], *carry: Column
) -> DataFrame:
    """Rows as messages: text key, JSON value, both UTF-8; ``carry`` is kept."""
    columns = [F.col(f) if isinstance(f, str) else f for f in fields]
    return df.select(
        F.encode(F.col(key).cast("string"), "UTF-8").alias("key"),
        encode_event(*columns).alias("value"),
        F.lit(topic).alias("topic"),
        *carry,
    )


def emit_counts(messages: DataFrame) -> DataFrame:
    """Messages per topic."""
    return messages.groupBy("topic").agg(F.count(F.lit(1)).alias("sent"))


def event_sink(
    messages: DataFrame, checkpoint: str, servers: str | None = None, path: str | None = None, **trigger
) -> StreamingQuery:
    """Start a streaming write of messages to a broker or to Parquet.

    One order's events share a key, and a broker maps equal keys to one partition.
    """
    writer = messages.writeStream.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if servers is not None:
        return writer.format("kafka").option("kafka.bootstrap.servers", servers).start()
    if path is None:
        raise ValueError("give either servers or path")
    return writer.format("parquet").outputMode("append").start(path)


def write_events(
    messages: DataFrame,
    servers: str | None = None,
    path: str | None = None,
    by_key: bool = False,
    partitions: int | None = None,
) -> None:
    """The batch form of :func:`event_sink`.

    ``by_key`` puts the messages of one key into one file, as a broker puts
    them into one partition; it costs a shuffle. ``partitions`` puts them into a folder for each partition that a
    broker with so many would choose (``broker_partition``; without a key by the value). A folder has several files, each of a range of
    the messages in order, so a key with many messages is not one task.
    """
    if partitions is not None and path is not None:
        chosen = F.coalesce(partition_of_key(F.col("key"), partitions), F.pmod(F.xxhash64("value"), F.lit(partitions)))
        order = ["broker_partition", "topic", "partition", "offset"]
        dealt = messages.withColumn("broker_partition", chosen.cast("int"))
        dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order)
        dealt.write.mode("append").option("compression", COMPRESSION).partitionBy("broker_partition").parquet(path)
        return
    if by_key and path is not None:
        messages = messages.repartition("key")
    if servers is not None:
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    elif path is not None:
        messages.write.mode("append").option("compression", COMPRESSION).parquet(path)
    else:
        raise ValueError("give either servers or path")
