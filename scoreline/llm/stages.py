"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> the documents that stay, with all their columns.

The last one returns where each document went. Other tables are read from
``sf_dir``. Null, empty and repeated rows fare as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language, line_dedup, near_dup, packing
from .common import table
from .queries import tokenizer


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no identified language go."""
    return language.keep_identified(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents of which no line but blank ones is left; n_chars follows the text."""
    rows = line_dedup.dedup_lines(docs)
    lost = F.col("line_counts.exact") + F.col("line_counts.near")
    rows = rows.filter((lost == 0) | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(lost == 0, F.col("n_chars")).otherwise(size))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, a similarity of 0.8."""
    return near_dup.drop_near_duplicates(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 4096 tokens."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), size=4096, end_id=1)
