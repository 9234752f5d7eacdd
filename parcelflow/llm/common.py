"""What several training-data operators share: table access, scratch tables, word hashes."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import parcelflow
from parcelflow.session import configure, scratch_dir

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
CHUNK_BYTES = 2 << 20  # texts handled at once in numpy; a single longer text is one chunk


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Batches to and from Python are whole texts and packed arrays: few rows, and few bytes, at a time.
_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def ready(spark: SparkSession) -> SparkSession:
    """Session settings, and the folder of this package on the Python workers' path.

    Where executors do not see that folder, submit the package with ``--py-files``.
    """
    configure(spark)
    for name, value in _BATCHES.items():
        spark.conf.set(name, value)
    root = str(Path(parcelflow.__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return spark


def whole_text(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def stored(df: DataFrame, purpose: str, narrow: bool = False) -> DataFrame:
    """Write to the shared scratch folder and read back; cuts the lineage for good.

    ``narrow`` is for tables that are a small part of the corpus and come out of a shuffle: an eighth as many tasks
    write them, so that they do not fall apart into a small file per task of the corpus.
    """
    spark = df.sparkSession
    if narrow:
        df = df.coalesce(max(2 * spark.sparkContext.defaultParallelism, shuffle_width(spark) // 8))
    path = scratch_dir(spark, purpose)
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")  # nothing reads them once the table is written
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_FREE_SHUFFLES) if before is None else spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with value computed once, however often and wherever body uses it.

    Inside a lambda, a plain column expression may be inlined and computed again per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- texts of an Arrow batch as one byte buffer ------------------------------


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a string array: (first row, end row, UTF-8 bytes, offsets from 0); nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    large = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if large else np.int32)[texts.offset :][: len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, end, raw[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (two xor-shift multiply rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_words(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_BYTE = random_words(256, 11)
_POWER = random_words(64, 12)


def _powers(n: int) -> np.ndarray:
    """Per-position multipliers, prolonged to the longest word seen."""
    global _POWER
    if n > len(_POWER):
        _POWER = random_words(max(n, 2 * len(_POWER)), 12)
    return _POWER


def word_runs(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each run of word bytes; runs end at row ends."""
    n = len(is_word)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = is_word[:-1]
    inner = offsets[1:-1]
    before[inner[inner < n]] = False
    starts = np.flatnonzero(is_word & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = is_word[1:]
    after[inner[(inner > 0) & (inner <= n)] - 1] = False
    ends = np.flatnonzero(is_word & ~after) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run: position-weighted sums of mixed bytes, then mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    power = _powers(int(lengths.max()))
    total = int(lengths.sum())
    index = np.int32 if len(data) < 1 << 31 else np.int64
    firsts = np.cumsum(lengths) - lengths
    within = np.arange(total, dtype=index) - np.repeat(firsts.astype(index), lengths)
    at = within + np.repeat(starts.astype(index), lengths)
    with np.errstate(over="ignore"):
        terms = _BYTE[data[at]]
        terms *= power[within]
        sums = np.add.reduceat(terms, firsts)
        return mix(sums + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
