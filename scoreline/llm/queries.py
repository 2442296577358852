"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fingerprints, hard_negatives, language, line_dedup, near_dup, ordered_packing, packing, pii, shards
from . import oracle, spelling, tokens, toxicity
from .common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "similarity", "word_start", F.col("n_words").cast("long")
    )


def op2_revealing_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_summary(table(spark, sf_dir, "documents"))


def op3_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.byte_shards(table(spark, sf_dir, "documents"), n_shards=24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_family_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(table(spark, sf_dir, "documents"))


def op6_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), size=4096, end_id=1)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        "text",
        F.col("line_counts.lines").alias("n_lines"),
        F.col("line_counts.exact").alias("exact_dropped"),
        F.col("line_counts.near").alias("near_dropped"),
    )


def op8_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op9_improbable_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), limit=512)


def op11_anchor_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    )
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op12_trie_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), garble=97)


def op13_ordered_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_packing.pack_in_order(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), size=2048, end_id=1)


QUERIES = {
    "op1_simhash_windows": op1_simhash_windows,
    "op2_revealing_terms": op2_revealing_terms,
    "op3_byte_shards": op3_byte_shards,
    "op4_compression_toxicity": op4_compression_toxicity,
    "op5_family_svm": op5_family_svm,
    "op6_best_two_fit": op6_best_two_fit,
    "op7_line_dedup": op7_line_dedup,
    "op8_bbit_minhash": op8_bbit_minhash,
    "op9_improbable_features": op9_improbable_features,
    "op10_token_counts": op10_token_counts,
    "op11_anchor_tree": op11_anchor_tree,
    "op12_trie_pairs": op12_trie_pairs,
    "op13_ordered_cuts": op13_ordered_cuts,
}

ORACLE: dict[str, str] = oracle.SQL
