"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations


import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import (
    chat,
    decontaminate,
    fingerprints,
    importance,
    licenses,
    ngram_join,
    packing,
    pii,
    quality,
    rules,
    token_counts,
    token_files,
    turn_repair,
)
from parcelflow.llm.common import ready, table, whole_text
from parcelflow.session import scratch_dir


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
    return scored.select(
        F.col("kept.doc_id").alias("doc_id"),
        quality.held_out(F.col("kept.doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.3).cast("int").alias("predicted"),
    )


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame(
        [(-7, 0, "user", marks), (-7, 1, "assistant", marks)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    done = chat.format_conversations(turns).withColumn("turns", chat.read_back(F.col("formatted")))
    done = done.withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.stored_pieces(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    # the ids are digested where they lie; only places and digests move
    packed = packing.place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return packed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token-files")
    manifest = token_files.write_token_files(
        table(spark, sf_dir, "documents"), folder, tokenizer("word_bpe_49k.json"), end_id=1
    )
    read = token_files.read_token_files(spark, folder, manifest)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.find_contamination(docs, items).groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"),
        F.max(F.col("matched") / F.col("windows")).alias("coverage"),
        F.max("exact").alias("exact"),
    )
    # by id and text: ids may be null, and rows of one id may differ
    rows = docs.select("doc_id", F.xxhash64(whole_text()).alias("text_hash")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.text_hash") == F.col("f.text_hash"))
    return rows.join(found.alias("f"), same, "left").select(
        "d.doc_id",
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("exact", F.lit(False)).alias("exact"),
    )


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, tokenizer("byte_bpe_50k.json"), scratch_dir(spark, "token-cache"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), windows=2)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"), keep=["doc_id"], count_copies=False)

    def as_text(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    def of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "term")
    return found.select(
        F.col("kept.doc_id").alias("doc_id"),
        *[of(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(as_text(base), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"),
    )


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(table(spark, sf_dir, "documents"), words=5, percent=75)


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    decisions = rules.fit_rules(docs, table(spark, sf_dir, "labels"))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rules.document_counts(docs, keep=["doc_id"]).select(
        F.col("kept.doc_id").alias("doc_id"),
        *["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
        base_failed.alias("base_failed"),
        (~base_failed & (decisions.verdict() == 1)).alias("kept"),
    )


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    figures = turn_repair.repair_figures(turn_repair.damage(turns)).withColumnRenamed("conv_id", "found_id")
    ids = turns.select("conv_id").distinct()  # a conversation may have lost all its rows
    empty = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    names = [c for c in figures.columns if c != "found_id"]
    return ids.join(figures, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").select(
        "conv_id", *[F.coalesce(c, empty.get(c, F.lit(0).cast("long"))).alias(c) for c in names]
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    drawn = importance.importance_resample(docs, target, keep=["doc_id"], words=1, buckets=10_000, percent=10)
    return drawn.select(F.col("kept.doc_id").alias("doc_id"), "n_features", "weight", "score", "rank")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def _ready(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(ready(spark), sf_dir)

    run.__name__ = query.__name__
    return run


QUERIES = {
    query.__name__: _ready(query)
    for query in (
        op1_quality_classifier,
        op2_chat_format,
        op3_best_fit_packing,
        op4_token_files,
        op5_benchmark_decontamination,
        op6_document_fingerprints,
        op7_token_counts,
        op8_license_scan,
        op9_pii,
        op10_ngram_jaccard_join,
        op11_quality_rules,
        op12_turn_repair,
        op13_importance_resampling,
        pipeline,
    )
}
