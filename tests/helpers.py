"""Small literal messages."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from parcelflow.schemas import KAFKA_SCHEMA

NOON = datetime(2024, 1, 1, 12)


def message(value, key=b"7", topic="orders", partition=0, offset=0, minutes=0):
    as_bytes = [bytearray(x.encode() if isinstance(x, str) else x) if x is not None else None for x in (key, value)]
    return (*as_bytes, topic, partition, offset, NOON + timedelta(minutes=minutes))


def frame(spark: SparkSession, *messages) -> DataFrame:
    return spark.createDataFrame(list(messages), KAFKA_SCHEMA)


def values(spark: SparkSession, *texts) -> DataFrame:
    """One order message per text, at offsets 0, 1, 2 ..."""
    return frame(spark, *[message(text, offset=i) for i, text in enumerate(texts)])
