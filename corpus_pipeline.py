"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scoreline.llm import stages
from scoreline.llm.common import materialize, table

STAGES = [
    ("language_id", stages.language_id),
    ("line_dedup", stages.line_dedup_stage),
    ("near_dedup", stages.near_dedup),
    ("decontamination", stages.decontamination),
    ("packing", stages.packing_stage),
]

#: No stage but the last could be put into SQL; tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
