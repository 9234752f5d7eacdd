"""Staging models: typed columns out of raw rows.

Each takes the raw events (or a raw table) as a DataFrame and works the same
on a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import castable_text, event_id, field, typed_field
from parcelflow.schemas import CONTRACTS, MESSAGE_KEY


def topic_filter(raw_events: DataFrame, topic: str) -> DataFrame:
    """One topic's rows; on the stored log this prunes the other topics' folders."""
    return raw_events.filter(F.col("kafka_topic") == topic)


def typed_events(raw_events: DataFrame, topic: str, on_error: str = "raise") -> DataFrame:
    """The contract columns of one topic.

    A malformed field stops the query (``raise``). With ``quarantine`` it
    becomes NULL and ``failed_fields`` lists the JSON names that failed. An
    ``offset_block`` column is passed on.
    """
    specs = CONTRACTS[topic]
    payload, spelled = F.col("payload"), F.col("spelled") if "spelled" in raw_events.columns else None
    columns = [
        event_id().alias("event_id"),
        *MESSAGE_KEY,
        "kafka_key",
        *[typed_field(payload, spec, on_error == "raise", spelled) for spec in specs],
        "ingested_at",
    ]
    if on_error == "quarantine":
        failures = [
            F.when(
                field(payload, s.json).isNotNull() & castable_text(payload, s, spelled).try_cast(s.type).isNull(),
                F.lit(s.json),
            )
            for s in specs
        ]
        columns.append(F.array_compact(F.array(*failures)).alias("failed_fields"))
    elif on_error != "raise":
        raise ValueError(f"on_error must be 'raise' or 'quarantine', not {on_error!r}")
    if "offset_block" in raw_events.columns:
        columns.append("offset_block")
    return topic_filter(raw_events, topic).select(*columns)


def split_failed(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows staged with ``on_error="quarantine"``: the sound ones, and the failed ones."""
    sound = F.size("failed_fields") == 0
    return staged.filter(sound).drop("failed_fields"), staged.filter(~sound)


def stg_orders(raw_events: DataFrame, on_error: str = "raise") -> DataFrame:
    return typed_events(raw_events, "orders", on_error)


def stg_payments(raw_events: DataFrame, on_error: str = "raise") -> DataFrame:
    return typed_events(raw_events, "payments", on_error)


def stg_shipments(raw_events: DataFrame, on_error: str = "raise") -> DataFrame:
    return typed_events(raw_events, "shipments", on_error)


# The raw dimension tables under the names the models use.
RENAMED = {
    "stg_products": ["product_id", "name AS product_name", "price", "category_id", "ingested_at"],
    "stg_customers": ["customer_id", "name AS customer_name", "email", "ingested_at"],
    "stg_categories": ["category_id", "name AS category_name", "ingested_at"],
}


def stg_products(raw_products: DataFrame) -> DataFrame:
    return raw_products.selectExpr(RENAMED["stg_products"])


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    return raw_customers.selectExpr(RENAMED["stg_customers"])


def stg_categories(raw_categories: DataFrame) -> DataFrame:
    return raw_categories.selectExpr(RENAMED["stg_categories"])
