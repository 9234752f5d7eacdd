"""Best-fit packing planned on a histogram of lengths.

Documents become pieces of at most ``max_len`` tokens. A plan needs only how many
pieces there are of each length (at most ``max_len`` counts, whatever the size of the
corpus): best-fit decreasing runs over those counts, moving whole groups of equal
sequences at a time. It yields slots, runs of consecutive ranks within a length that go to consecutive
sequences. Pieces then take their slots by joining on their rank within their length.

Ranks need no global sort: a piece knows its rank among the equal lengths of its own
task, and the counts per task and length, summed up, give each task its first rank.

Defined results: null text is empty and holds the end id alone; repeated rows are packed as
often as they occur; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm import bpe
from parcelflow.llm.common import stored, whole_text

PIECES = "doc_id long, piece int, start long, length int, ids binary, part int, local_rank long"


def pieces_of(docs: DataFrame, tokenizer: str, max_len: int = 1024, end_id: int = 2) -> DataFrame:
    """(doc_id, piece, start, length, ids, part, local_rank); ids are little-endian uint32.

    A document's ids end with ``end_id``. A document over ``max_len`` is cut into pieces of ``max_len``; its first piece
    takes the remainder. ``part`` and ``local_rank`` depend on the order of the
    rows a task sees, so store the result before using them.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()),
         ("ids", pa.binary()), ("part", pa.int32()), ("local_rank", pa.int64())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(max_len + 1, np.int64)
        for batch in batches:
            for at in range(0, len(batch), 1000):
                rows = batch.slice(at, 1000)
                out: dict[str, list] = {name: [] for name in schema.names}
                for doc_id, ids in zip(rows["doc_id"].to_pylist(), bpe.ids_of(tokenizer, rows["text"]), strict=True):
                    whole = np.append(ids, np.uint32(end_id)).astype("<u4")
                    first = len(whole) % max_len or max_len
                    starts = [0, *range(first, len(whole), max_len)]
                    for piece, (start, end) in enumerate(zip(starts, [*starts[1:], len(whole)], strict=True)):
                        length = end - start
                        values = (doc_id, piece, start, length, whole[start:end].tobytes(), part, int(seen[length]))
                        for name, value in zip(schema.names, values, strict=True):
                            out[name].append(value)
                        seen[length] += 1
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(cut, PIECES)


def plan_slots(counts: dict[int, int], max_len: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, count, first sequence, offset).

    The ranks first .. first+count-1 of a length go to the sequences from ``first sequence`` on,
    one each, at ``offset``. The number of slots depends on the lengths, not on the counts.
    """
    slots: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free tokens -> groups (first sequence, count)
    sequences = 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            free = next((r for r in range(length, max_len) if room.get(r)), None)
            if free is None:
                break
            first, n = room[free].pop()
            used = min(n, left)
            if used < n:
                room[free].append((first + used, n - used))
            slots.append((length, rank, used, first, max_len - free))
            room[free - length].append((first, used))
            rank, left = rank + used, left - used
        each = max_len // length
        for per_sequence, n in ((each, left // each), (left % each, 1 if left % each else 0)):
            if n:
                for i in range(per_sequence):
                    slots.append((length, rank, n, sequences, i * length))
                    rank += n
                room[max_len - per_sequence * length].append((sequences, n))
                sequences += n
    return slots


def place(pieces: DataFrame, max_len: int = 1024) -> DataFrame:
    """Add sequence_id and offset to stored pieces.

    The driver sees one count per length. The counts per task and length, joined back
    on (part, length), are as many as tasks times lengths. Slots are at most a fixed number for
    a given ``max_len``, so broadcasting them is safe.
    """
    spark = pieces.sparkSession
    by_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = by_part.withColumn("first_rank", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.createDataFrame(
        plan_slots(counts, max_len), "length int, first_slot long, slot_count long, first_sequence long, offset int"
    )
    runs = slots.groupBy(F.col("length").alias("slot_length")).agg(
        F.sort_array(F.collect_list(F.struct("first_slot", "slot_count", "first_sequence", "offset"))).alias("runs")
    )
    ranked = (
        pieces.join(by_part.select("part", "length", "first_rank"), ["part", "length"])
        .withColumn("rank", F.col("first_rank") + F.col("local_rank"))
        .join(F.broadcast(runs), F.col("length") == F.col("slot_length"))
    )
    run = F.filter(
        "runs", lambda r: (r["first_slot"] <= F.col("rank")) & (F.col("rank") < r["first_slot"] + r["slot_count"])
    )
    placed = ranked.withColumn("slot", F.element_at(run, 1))
    return placed.select(
        *pieces.columns,
        (F.col("slot.first_sequence") + F.col("rank") - F.col("slot.first_slot")).alias("sequence_id"),
        F.col("slot.offset").cast("long").alias("offset"),
    )


def stored_pieces(docs: DataFrame, tokenizer: str, max_len: int = 1024, end_id: int = 2) -> DataFrame:
    """All pieces with their ids, on the shared folder: what ``place`` starts from."""
    return stored(pieces_of(docs, tokenizer, max_len, end_id), "pieces")


def pack(docs: DataFrame, tokenizer: str, max_len: int = 1024, end_id: int = 2) -> DataFrame:
    """All pieces with ids, sequence_id and offset."""
    return place(stored_pieces(docs, tokenizer, max_len, end_id), max_len)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed pieces of each sequence put together, at most max_len ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b""), lambda all_ids, x: F.concat(all_ids, x["ids"])).alias("ids")
    )
