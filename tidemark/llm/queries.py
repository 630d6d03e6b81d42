"""Registered queries: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import conversation_repair, decontamination, divergence_audit, jaccard_join, language_id, line_dedup, packing, quality_classifier, repetition, setsketch_dedup, suffix_tree_lm, token_counts, token_store
from tidemark.llm.common import crc_fold, named_rows
from tidemark.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, crc_fold() != 0)
    return found.select("doc_id", (crc_fold() == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_tree_lm.score(table(spark, sf_dir, "documents"), crc_fold() != 1)
    return found.withColumn("held_out", crc_fold() == 1)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER, capacity=2048, end_id=0, added_tokens=True)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_histogram(table(spark, sf_dir, "documents"), TOKENIZER, added_tokens=True)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    names = F.array_join(F.array_sort("items"), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_fold() != 0)
    return found.select("doc_id", (crc_fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar(table(spark, sf_dir, "documents"), percent=90, length=3)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines (distinct lines) and the places of those that stay."""
    docs = named_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", "row")
    kept = line_dedup.kept_lines(docs, percent=80, id_col="row")
    sizes = docs.select("doc_id", "row", F.coalesce(F.size(line_dedup.distinct_lines(F.col("text"))), F.lit(0)).alias("n_lines"))
    met = sizes.join(kept, sizes["row"] == kept["doc"], "left")
    return met.select(
        "doc_id",
        F.greatest("n_lines", F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("kept"), F.lit(0)).cast("long").alias("n_kept"),
        F.coalesce(F.array_join(F.col("kept").cast("array<string>"), ","), F.lit("")).alias("kept_lines"),
    )


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-store")
    token_store.write(table(spark, sf_dir, "documents"), path, TOKENIZER, end_id=2, added_tokens=True)
    return token_store.read(spark, path)


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=80, length=2)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit.audit(table(spark, sf_dir, "documents"), min_docs=3, top=200)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = conversation_repair.rows_of(table(spark, sf_dir, "conversations"))
    return conversation_repair.report(original, conversation_repair.damage(original, parts=20))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_token_counts": op4_token_counts,
    "op5_quality_rules": op5_quality_rules,
    "op6_decontamination": op6_decontamination,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_line_dedup": op9_line_dedup,
    "op10_token_store": op10_token_store,
    "op11_minhash_near_dedup": op11_minhash_near_dedup,
    "op12_source_divergence": op12_source_divergence,
    "op13_conversation_repair": op13_conversation_repair,
}
