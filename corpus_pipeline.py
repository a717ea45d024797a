"""Corpus pipeline: quality, exact and near duplicates, benchmark passages, mix. Each stage is one operator of the library.

Null texts are empty ones; rows with a null id, repeated rows and columns that ``documents`` does not have are taken along, as the
operators say. Without documents every stage gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from placefolio.llm import decontaminate, exact_dedup, mixing, near_dedup, quality
from placefolio.llm.common import table
from placefolio.session import staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects."""
    return quality.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_duplicates(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.drop_near_duplicates(docs, threshold=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that contain benchmark passages."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, with the number of the repetition."""
    return mixing.mixed_rows(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

# A trained classifier decides the first stage, which SQL cannot express; tests/llm compares every stage and the whole run
# with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
