"""From Kafka-shaped messages to audited event rows.

Every message gets one outcome, tested in this order:

* ``bad``       - no value, not UTF-8, not one JSON value, or JSON null
* ``error``     - well-formed but not storable (undecodable key, NaN, NUL, half a surrogate pair)
* ``duplicate`` - its (topic, partition, offset) is already taken
* ``written``   - stored
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import (
    decode_key,
    decode_utf8,
    has_lone_surrogate,
    has_nul_character,
    is_non_finite_json,
    offset_block,
    spelled_numbers,
    undecodable_key,
    with_strict_json,
)
from parcelflow.functions.keys import BLOCK_BITS
from parcelflow.schemas import EVENT_LOG, MESSAGE_KEY

# One exchange on this identity serves the in-batch and the history check.
# reject_id tells apart rejected messages that share an offset.
_IDENTITY = [*MESSAGE_KEY, "outcome", "reject_id"]


def classify(frame: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rename to envelope columns and add ``outcome``, ``reason`` and ``payload``; ``keep`` are columns passed on.

    A narrow projection: outcome is ``written``, ``bad`` or ``error`` here;
    repeats are found later.
    """
    text, payload = F.col("_text"), F.col("_json")
    parsed = with_strict_json(frame.withColumn("_text", decode_utf8(F.col("value"))), "_text", "_json")
    reasoned = parsed.withColumn(
        "_bad",
        F.when(F.col("value").isNull(), "no value")
        .when(text.isNull(), "value is not utf-8")
        .when(payload.isNull() & ~is_non_finite_json(text), "value is not json")
        .when(F.is_variant_null(payload), "value is json null"),
    ).withColumn(
        "_error",
        F.when(undecodable_key(F.col("key")), "key is not utf-8")
        .when(payload.isNull(), "number is not finite")
        .when(has_nul_character(text), "text holds a nul character")
        .when(has_lone_surrogate(text), "text holds half a surrogate pair"),
    )
    outcome = (
        F.when(F.col("_bad").isNotNull(), "bad")
        .when(F.col("_error").isNotNull(), "error")
        .otherwise("written")
    )
    accepted = outcome == "written"
    return reasoned.select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.when(accepted, decode_key(F.col("key"))).alias("kafka_key"),
        F.when(accepted, payload).alias("payload"),
        F.when(accepted, spelled_numbers(text, payload)).alias("spelled"),
        F.col("timestamp").alias("message_ts"),
        outcome.alias("outcome"),
        F.coalesce("_bad", "_error").alias("reason"),
        F.when(~accepted, F.col("key")).alias("raw_key"),
        F.when(~accepted, F.col("value")).alias("raw_value"),
        F.when(accepted, F.lit("")).otherwise(_fingerprint(F.col("key"), F.col("value"))).alias("reject_id"),
        F.xxhash64("value").alias("_value_hash"),
        *keep,
    )


def _fingerprint(key: Column, value: Column) -> Column:
    def part(data: Column) -> Column:
        return F.coalesce(F.sha2(data, 256), F.lit("-"))

    return F.concat(part(key), part(value))


def bad_messages(frame: DataFrame) -> DataFrame:
    """The messages whose value cannot be read, with the reason."""
    return (
        classify(frame)
        .filter(F.col("outcome") == "bad")
        .select(*MESSAGE_KEY, "reason", "raw_key", "raw_value", "message_ts")
    )


def merge_copies(classified: DataFrame) -> DataFrame:
    """One row per message identity with its number of ``copies``.

    The earliest delivery wins. The aggregate combines map-side, so a message
    redelivered any number of times reaches the shuffle once per input task.
    """
    kept = ["kafka_key", "payload", "spelled", "reason", "raw_key", "raw_value", "message_ts"]
    return (
        classified.groupBy(*_IDENTITY)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min_by(F.struct(*kept), F.struct("message_ts", "_value_hash")).alias("_first"),
        )
        .select(*_IDENTITY, "copies", "_first.*")
    )


def fresh_rows(
    frame: DataFrame, clock: Column | None = None, block_bits: int = BLOCK_BITS, lone: str | None = None
) -> DataFrame:
    """Event-log rows of messages known to be delivered for the first time.

    A projection: payloads are neither shuffled nor sorted. ``lone`` names a column that is true for messages that come once in their
    batch, at a place where the log holds an event and nothing else: a sound one is a duplicate, another is rejected for the first time.
    """
    rows = classify(frame) if lone is None else classify(frame, keep=(lone,))
    again = F.lit(False) if lone is None else (F.col("outcome") == "written") & F.col(lone)
    once = {"copies": F.lit(1).cast("bigint"), "redelivery": again}
    if lone is not None:
        once["outcome"] = F.when(again, "duplicate").otherwise(F.col("outcome"))
        once |= {c: F.when(~again, F.col(c)) for c in ("payload", "spelled")}
    return _as_log(rows.withColumns(once), clock, block_bits, F.lit(False))


def log_rows(
    frame: DataFrame,
    known: DataFrame | None = None,
    clock: Column | None = None,
    block_bits: int = BLOCK_BITS,
    held: str | None = None,
) -> DataFrame:
    """The event-log rows of messages that may repeat each other or stored ones.

    ``known`` holds the identities already stored (see ``EventLog``). A stored
    message costs one row with its payload; repeats cost one narrow row, so
    the sum of ``copies`` always equals the number of messages received.

    Rows that an earlier attempt of the same batch stored (``known.own``) come out again, marked ``stored``: they are
    what this batch consists of, to be counted but not to be written.

    ``held`` names a column that tells where ``known`` has an event; a sound message there needs no payload.
    """
    if held is None:
        classified = classify(frame)
    else:
        repeat = (F.col("outcome") == "written") & F.col(held)
        classified = classify(frame, keep=(held,))
        classified = classified.withColumns({c: F.when(~repeat, F.col(c)) for c in ("payload", "spelled")}).drop(held)
    merged = merge_copies(classified)
    seen, own, own_again = F.lit(False), F.lit(False), F.lit(False)
    if known is not None:
        merged = merged.join(_by_identity(known), _IDENTITY, "left")
        seen, own, own_again = [F.coalesce(c, F.lit(False)) for c in ("_seen", "_own", "_own_again")]

    accepted = F.col("outcome") == "written"
    repeats = F.when(seen & ~own, F.col("copies")).otherwise(F.col("copies") - 1)

    def entry(outcome: Column, copies: Column, redelivery: bool, stored: Column) -> Column:
        return F.struct(
            outcome.alias("outcome"),
            copies.cast("bigint").alias("copies"),
            F.lit(redelivery).alias("redelivery"),
            stored.alias("stored"),
        )

    first = F.when(~seen | own, entry(F.col("outcome"), F.lit(1), False, own))
    again = F.when(
        repeats > 0,
        entry(F.when(accepted, "duplicate").otherwise(F.col("outcome")), repeats, True, own_again),
    )
    entries = merged.withColumn("_entry", F.explode(F.array_compact(F.array(first, again))))
    body = ["payload", "spelled", "raw_key", "raw_value"]
    stored = {c: F.when(~F.col("_entry.redelivery"), F.col(c)) for c in body}
    counted = {c: F.col(f"_entry.{c}") for c in ("outcome", "copies", "redelivery")}
    return _as_log(entries.withColumns({**stored, **counted}), clock, block_bits, F.col("_entry.stored"))


def _by_identity(known: DataFrame) -> DataFrame:
    """Whether a message is stored, and whether this batch's own earlier attempt stored it, or its repeats."""
    flags = {"_seen": ~F.col("redelivery"), "_own": ~F.col("redelivery") & F.col("own"), "_own_again": F.col("redelivery") & F.col("own")}
    accepted = F.when(F.col("outcome") == "duplicate", "written").otherwise(F.col("outcome")).alias("outcome")
    rows = known.select(*MESSAGE_KEY, accepted, "reject_id", *[flag.alias(name) for name, flag in flags.items()])
    return rows.groupBy(*_IDENTITY).agg(*[F.max(name).alias(name) for name in flags])


def _as_log(rows: DataFrame, clock: Column | None, block_bits: int, stored: Column) -> DataFrame:
    now = F.current_timestamp() if clock is None else clock
    stamps = {
        "event_ts": now,
        "ingested_at": now,
        "offset_block": offset_block(F.col("kafka_offset"), block_bits),
        "owner": F.lit(None).cast("string"),
    }
    return rows.withColumns(stamps).select(*EVENT_LOG.fieldNames(), stored.alias("stored"))


def outcome_counts(log: DataFrame) -> DataFrame:
    """Messages per topic and outcome, from event-log rows."""
    return log.groupBy(F.col("kafka_topic").alias("topic"), "outcome").agg(
        F.sum("copies").cast("bigint").alias("messages")
    )
