"""Event identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A block is 2**20 consecutive offsets. Blocks are the partition folders of stored
# events, so a lookup by (topic, offset) opens only the blocks it needs.
BLOCK_BITS = 20


def event_id(
    topic: str = "kafka_topic", partition: str = "kafka_partition", offset: str = "kafka_offset"
) -> Column:
    """``topic-partition-offset``, for example ``orders-1-5``."""
    return F.concat_ws("-", F.col(topic), F.col(partition), F.col(offset))


def offset_block(offset: Column, bits: int = BLOCK_BITS) -> Column:
    return F.shiftright(offset, bits)


def with_row_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Unique but not contiguous numbers; use ``event_id`` as the stable key."""
    return df.select(F.monotonically_increasing_id().alias(name), "*")


# Fixed values of the 32-bit hash that brokers' default partitioner takes of a key.
_SEED, _FACTOR, _LOW32 = 0x9747B28C, 0x5BD1E995, 0xFFFFFFFF


def _once(value: Column, body) -> Column:
    """``body(value)`` with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _times(x: Column) -> Column:
    return (x * F.lit(_FACTOR)).bitwiseAND(F.lit(_LOW32))  # below 2^63: no overflow


def _folded(x: Column, bits: int) -> Column:
    return x.bitwiseXOR(F.shiftrightunsigned(x, bits))


def key_hash(key: Column) -> Column:
    """The default partitioner's hash of a binary key, as an unsigned 32-bit number: murmur2 over its bytes.

    Words of four bytes, little-endian, are mixed and folded into the hash one after the other, then the one to three bytes left.
    """
    size = F.octet_length(key)
    digits = F.hex(key)

    def number(first: Column, n: int) -> Column:
        """n bytes from a place on, the last one highest."""
        places = [F.substring(digits, 2 * (first + i) + 1, F.lit(2)) for i in reversed(range(n))]
        return F.conv(F.concat(*places), 16, 10).cast("bigint")

    words = F.floor(size / 4).cast("int")
    none = F.array().cast("array<bigint>")
    read = F.when(words > 0, F.transform(F.sequence(F.lit(0), words - 1), lambda i: number(i * 4, 4))).otherwise(none)
    mixed = F.transform(F.transform(F.transform(read, _times), lambda k: _folded(k, 24)), _times)
    start = size.cast("bigint").bitwiseXOR(F.lit(_SEED))
    body = F.aggregate(mixed, start, lambda h, k: _times(h).bitwiseXOR(k))
    rest = [F.when(size % 4 == n, number(size - n, n)) for n in (1, 2, 3)]
    left = F.coalesce(*rest)
    with_rest = _once(body, lambda h: F.when(left.isNull(), h).otherwise(_times(h.bitwiseXOR(left))))
    return _once(_once(with_rest, lambda h: _times(_folded(h, 13))), lambda h: _folded(h, 15))


def partition_of_key(key: Column, partitions: int) -> Column:
    """The partition a broker's default partitioner puts a key into; NULL without a key."""
    positive = key_hash(key).bitwiseAND(F.lit(0x7FFFFFFF))
    return F.when(key.isNotNull(), (positive % partitions).cast("int"))
