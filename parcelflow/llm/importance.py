"""Importance resampling: draw the documents whose n-grams are likelier in a target corpus.

*Scan.* A text's bytes are lower-cased (A-Z) and each run of separators becomes one space; a regular expression with
lookarounds at the word's edges runs over them with ``overlapped=True``, so its matches are the spans of all runs of n
words, for n from 1 to ``words``. Words are runs of ASCII letters and digits and of all characters beyond ASCII. A span's bucket is
the CRC-32 of its bytes modulo ``buckets``. The buckets of a document are written once, as a packed array; counting and
weighing read those arrays and no text.

*Weight.* With s of the corpus's S features and t of the target's T in a bucket, the bucket's gain is
floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))), B the number of buckets. A document's weight is the floored mean of its features' gains.
What travels of counts and gains is ``buckets`` numbers, whatever the corpus.

*Draw.* Score = weight + Gumbel noise that a hash of seed and doc_id fixes. The floor(percent N / 100) highest scores are drawn, of the N
documents with ``min_words`` words. Scores are whole numbers within a bounded range, so the cutoff comes out of a histogram of them; only rows that
reach it are ordered, by ranges, and ranked by their place in their range after all rows of the ranges before.

Defined results: null text has no words and weight 0; a null doc_id is the empty text to the hash and the largest in a tie; rows that repeat a
doc_id are documents of their own, in a tie the one with fewer features goes first; an empty target, or no documents, is all zeros, or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import shuffle_width, stored, whole_text

# A-Z to a-z; ASCII that is neither letter nor digit to a space; bytes of longer characters as they are.
_FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())
_SPACES = regex.compile(rb"  +")
_PLACE = (1 << 33) - 1  # low bits of monotonically_increasing_id(): the place within a partition


def n_gram_pattern(n: int) -> regex.Pattern:
    """A run of exactly n words, beginning and ending at a word's edge."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def bucket_scanner(words: int, buckets: int):
    """text -> (number of words, bucket of every feature)."""
    patterns = [n_gram_pattern(n) for n in range(1, words + 1)]

    def scan(text: str) -> tuple[int, np.ndarray]:
        flat = _SPACES.sub(b" ", text.encode().translate(_FOLD))
        sums = [
            np.fromiter((crc32(found[0]) for found in pattern.finditer(flat, overlapped=True)), np.uint32)
            for pattern in patterns
        ]
        return len(sums[0]), np.concatenate(sums) % np.uint32(buckets)

    return scan


def _packed(buckets: int):
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def scan_features(docs: DataFrame, keep: list[str], words: int, buckets: int) -> DataFrame:
    """(kept, row, n_words, n_features, features): a packed array of buckets for every document."""
    wanted = docs.select(
        F.struct(*keep).alias("kept"), F.monotonically_increasing_id().alias("row"), whole_text().alias("text")
    )
    kind = _packed(buckets)

    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = bucket_scanner(words, buckets)
        for batch in batches:
            found = [scan(text.as_py()) for text in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["kept"],
                    batch["row"],
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([len(f) for _, f in found], pa.int64()),
                    pa.array([f.astype(kind).tobytes() for _, f in found], pa.binary()),
                ],
                names=["kept", "row", "n_words", "n_features", "features"],
            )

    schema = wanted.select("kept", "row").schema
    for name in ("n_words", "n_features"):
        schema = schema.add(name, "long")
    return wanted.mapInArrow(scan_batches, schema.add("features", "binary"))


def _arrays(cells: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """The packed arrays of a batch end to end, and where each begins and ends."""
    parts = [np.frombuffer(cell.as_buffer(), kind) for cell in cells]
    ends = np.cumsum([0, *map(len, parts)])
    return np.concatenate(parts) if parts else np.zeros(0, kind), ends


def bucket_counts(scanned: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n) over all features; a task sends at most one row per bucket."""
    kind = _packed(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_arrays(batch["features"], kind)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["bucket", "n"])

    partial = scanned.select("features").mapInArrow(count, "bucket long, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """The gain of every bucket, from (bucket, n) of both sides: ``buckets`` numbers on the driver."""
    counts = np.zeros((2, buckets), np.int64)
    for side, table in enumerate((source, target)):
        for row in table.collect():
            counts[side, row["bucket"]] = row["n"]
    s, t = counts.astype(float)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(scanned: DataFrame, gains: np.ndarray) -> DataFrame:
    """Scanned documents with ``weight`` in place of their features."""
    kind = _packed(len(gains))
    table = scanned.sparkSession.sparkContext.broadcast(gains)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, ends = _arrays(batch["features"], kind)
            upto = np.concatenate([[0], np.cumsum(table.value[features])])
            weight = (upto[ends[1:]] - upto[ends[:-1]]) // np.maximum(np.diff(ends), 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(weight, pa.int64())], names=[*batch.schema.names[:-1], "weight"]
            )

    schema = scanned.drop("features").schema.add("weight", "long")
    return scanned.mapInArrow(apply, schema)


def gumbel_noise(doc_id: Column, seed: int) -> Column:
    """floor(1000 g) of a Gumbel draw g that seed and id fix."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def draw(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """``rank`` 1, 2, 3 ... by falling score for the rows drawn, null for the others.

    ``scored`` is a stored table with kept.doc_id, row, n_words, n_features and score.
    """
    spark = scored.sparkSession
    eligible = F.col("n_words") >= min_words
    levels = scored.filter(eligible).groupBy("score").agg(F.count("*").alias("n"))  # a row per whole score
    upto = F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0))
    wanted = F.floor(F.lit(percent) * F.sum("n").over(Window.partitionBy()) / 100).cast("long")
    found = (
        levels.select("score", upto.alias("upto"), wanted.alias("wanted"))
        .agg(F.max("wanted").alias("wanted"), F.max(F.when(F.col("upto") >= F.col("wanted"), F.col("score"))).alias("cutoff"))
        .first()
    )
    no_rank = F.lit(None).cast("long").alias("rank")
    if not found["wanted"]:
        return scored.select("*", no_rank)
    reached = eligible & (F.col("score") >= found["cutoff"])
    order = [F.desc("score"), F.asc_nulls_last("kept.doc_id"), F.asc("n_features"), F.asc("row")]
    ranges = scored.filter(reached).repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
    ranges = stored(ranges.withColumn("place", F.monotonically_increasing_id()), "draw")
    part = F.shiftright("place", 33)
    sizes = ranges.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row per range
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = ranges.withColumn("part", part).join(sizes.select("part", before.alias("before")), "part")
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit(_PLACE)) + 1
    rank = F.when(rank <= found["wanted"], rank).alias("rank")
    return scored.filter(~reached).select("*", no_rank).unionByName(ranked.select(*scored.columns, rank))


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    keep: list[str],
    words: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """(kept, row, n_words, n_features, weight, score, rank) for every document; ``keep`` names doc_id among others.

    ``rank`` is null for documents that are not drawn: ``filter("rank is not null")`` is the sample.
    """
    scanned = stored(scan_features(docs, keep, words, buckets), "features")
    wanted = scan_features(target.select("text"), ["text"], words, buckets).drop("kept")
    gains = bucket_gains(bucket_counts(scanned, buckets), bucket_counts(wanted, buckets), buckets)
    weighed = weigh(scanned, gains)
    scored = weighed.withColumn("score", F.col("weight") + gumbel_noise(F.col("kept.doc_id"), seed))
    return draw(stored(scored, "scored"), percent, min_words)
