"""Token counts from a digest cache.

A text is known by the SHA-256 of its content and the digest of the vocabulary file. Counts are looked up by
that pair; of the texts that are not stored yet, each distinct one is encoded once, and the new counts are
appended to the cache, which is an ordinary table that later runs and other corpora share. The content is
not changed before it is digested: the tokenizers here keep case and white space, so any
normalisation could make unlike counts equal.

Defined results: null text counts as empty (0 tokens); repeated rows are returned as often as they occur;
an empty table gives no rows and appends nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import bpe
from parcelflow.llm.common import whole_text

CACHE = "digest binary, tokenizer string, n_tokens long"


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; an absent cache is empty. A pair stored twice by racing jobs counts once."""
    try:
        found = spark.read.schema(CACHE).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], CACHE)
    return found.groupBy("digest", "tokenizer").agg(F.max("n_tokens").alias("n_tokens"))


def _encoded(texts: DataFrame, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) of (digest, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                rows = batch.slice(at, 1000)
                sizes = [len(ids) for ids in bpe.ids_of(tokenizer, rows["text"])]
                yield pa.RecordBatch.from_arrays(
                    [rows["digest"], pa.array(sizes, pa.int64())], names=["digest", "n_tokens"]
                )

    return texts.select("digest", "text").mapInArrow(count, "digest binary, n_tokens long")


def count_tokens(docs: DataFrame, tokenizer: str, cache_path: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row; fills the cache at ``cache_path`` first."""
    spark = docs.sparkSession
    name = bpe.version(tokenizer)
    text = whole_text()
    digests = docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).alias("n_bytes"))
    stored = read_cache(spark, cache_path).filter(F.col("tokenizer") == name)
    # one document stands for each unknown content: its text moves once, copies stay where they are
    missing = (
        digests.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).join(stored, "digest", "left_anti")
    )
    texts = docs.select("doc_id", text.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    same = texts["doc_id"].eqNullSafe(missing["doc_id"]) & (texts["digest"] == missing["digest"])
    counted = _encoded(texts.join(missing, same, "left_semi"), tokenizer)
    counted.select("digest", F.lit(name).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)
    known = read_cache(spark, cache_path).filter(F.col("tokenizer") == name)
    return digests.join(known.select("digest", "n_tokens"), "digest").select(
        "doc_id",
        F.col("n_bytes").cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
