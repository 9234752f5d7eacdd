"""Sets of message positions as bits, in pages of 1024 consecutive offsets, small enough to be broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PAGE_BITS, _WORDS = 10, 16  # a page is 16 words of 64 bits


def _bit_in_page(offset: Column) -> tuple[Column, Column]:
    """The word of an offset in its page, and its bit in the word."""
    word = F.shiftright(offset, 6).bitwiseAND(F.lit(_WORDS - 1)).cast("int")
    return word, offset.bitwiseAND(F.lit(63)).cast("int")


def page_of(offset: str) -> Column:
    return F.shiftright(offset, _PAGE_BITS)


def bit_pages(positions: DataFrame, place: list[str], flags: list[str], *others: Column) -> DataFrame:
    """A row per topic, partition and page: for each flag the bits of the positions where it holds.

    ``place`` names the columns with topic, partition and offset, ``others`` are further aggregates of a page.
    """
    topic, partition, offset = place
    word, bit = _bit_in_page(F.col(offset))
    one = positions.withColumns({"_page": page_of(offset), "_word": word, "_one": F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)})
    words = [F.bit_or(F.when(F.col(f) & (F.col("_word") == i), F.col("_one"))).alias(f"{f}_{i}") for f in flags for i in range(_WORDS)]
    return one.groupBy(F.col(topic).alias("topic"), F.col(partition).alias("partition"), "_page").agg(*words, *others)


def with_flags(rows: DataFrame, pages: DataFrame, place: list[str], flags: list[str]) -> DataFrame:
    """The rows with each flag: true where the pages have the bit of their position. Count the pages first: they are broadcast."""
    topic, partition, offset = place
    word, bit = _bit_in_page(F.col(offset))

    def found(flag: str) -> Column:
        return F.coalesce(F.getbit(F.get(F.array(*[F.col(f"{flag}_{i}") for i in range(_WORDS)]), word), bit) == 1, F.lit(False))

    known = pages.withColumnsRenamed({"topic": "_topic", "partition": "_partition", "_page": "_known_page"})
    here = (F.col(topic) == F.col("_topic")) & (F.col(partition) == F.col("_partition")) & (page_of(offset) == F.col("_known_page"))
    return rows.join(F.broadcast(known), here, "left").select(*[F.col(c) for c in rows.columns], *[found(f).alias(f) for f in flags])
