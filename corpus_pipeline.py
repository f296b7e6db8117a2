"""Corpus pipeline: quality rules, near duplicates, decontamination, personal data, packing. Part of the llm subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from boxwright.llm import op3_packing, op5_pii, op6_outliers, op7_chosen_path, op10_decontaminate
from boxwright.llm._shared import documents, removed, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the robust outlier test rejects."""
    return op6_outliers.stage(spark, docs, sf_dir)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return op7_chosen_path.stage(spark, docs, sf_dir)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those that mostly are such passages go."""
    return op10_decontaminate.stage(spark, docs, sf_dir)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by marks of its kind."""
    return op5_pii.stage(spark, docs, sf_dir)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens, with their token ids (see op3_packing)."""
    return op3_packing.pieces(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("personal_data", personal_data), ("pack", pack)]

#: The fits and joins of the stages are not expressible in SQL; tests/llm holds the
#: stages against plain restatements on a fixture with planted cases.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each stage's rows are written to the shared folder and read again, and deleted when the next are."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        if before is not None:
            removed(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
