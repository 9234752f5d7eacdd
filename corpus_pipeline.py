"""A corpus from documents to packed sequences: classify, deduplicate, decontaminate, sanitise, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's docs. All
but the last return the columns of documents. A document without doc_id is told apart by its text.
Null texts are empty to every decision and stay null in the rows that are kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelflow.llm import decontaminate, ngram_join, packing, pii, quality
from parcelflow.llm.common import ready, stored, table, whole_text

MIN_QUALITY = 0.3
TOKENIZER = "byte_bpe_50k.json"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = table(ready(spark), sf_dir, "labels")
    scored = quality.quality_scores(docs, labels, keep=docs.columns)
    return scored.filter(F.col("quality_score") >= MIN_QUALITY).select("kept.*")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that n-gram links connect: that of the smallest doc_id.

    Rows that repeat a doc_id are one document; of their texts the smallest stays.
    """
    ready(spark)
    identity = F.coalesce("doc_id", F.xxhash64(whole_text()))
    linked = ngram_join.link_documents(docs.select(identity.alias("doc_id"), "text"))
    first = linked.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("kept_id")).distinct()
    of_document = Window.partitionBy("kept_id").orderBy("doc.text")
    rows = docs.select(F.struct(*docs.columns).alias("doc"), identity.alias("kept_id")).join(first, "kept_id")
    return rows.withColumn("nth", F.row_number().over(of_document)).filter("nth = 1").select("doc.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.decontaminate(docs, table(ready(spark), sf_dir, "benchmark"))


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and terms that disclose it replaced; n_chars follows the text."""
    ready(spark)
    found = pii.find_personal_data(docs, keep=docs.columns, count_copies=False)
    clean = found.withColumn("clean", pii.sanitise(F.col("kept.text"), F.col("spans")))
    new = {"text": F.col("clean"), "n_chars": F.length("clean")}

    def column(name: str):
        old = F.col(f"kept.{name}")
        return F.when(F.size("spans") > 0, new[name]).otherwise(old).alias(name) if name in new else old.alias(name)

    return clean.select(*[column(name) for name in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids and places in sequences of at most 1024 tokens."""
    ready(spark)
    packed = packing.pack(docs, public_tokenizers.path(TOKENIZER))
    return packed.select("doc_id", "piece", "start", "length", "sequence_id", "offset", "ids")


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("personal data", remove_personal_data),
    ("best-fit packing", pack),
]

# Neither a trained network nor token ids are expressible in SQL; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents, each written to the shared folder before the next."""
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
