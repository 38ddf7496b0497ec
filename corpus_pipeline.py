"""The text pipeline: each stage takes the documents its predecessor kept.

The stages but the last return the columns of the documents they are given. Every stage works
on whole texts and on all its input; `run` writes what a stage returns to the shared scratch
folder and reads it again for the next one. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradeloom.llm import decontaminate, mixing, parity, pii, quality
from tradeloom.llm.frames import col, free_name, prepare
from tradeloom.sources.scratch import materialize


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality, by text and site, reaches the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    found = free_name(docs, "quality")
    judged = quality.judge(docs, quality.train(docs, labels), found)
    return judged.where(col(found).kept).drop(found)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one with the smallest id."""
    return parity.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the new text."""
    return pii.redact(docs, pii.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, its copies numbered from 1."""
    return mixing.emit(docs)


def _prepared(stage):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepare(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality", _prepared(reject_low_quality)),
    ("near_copies", _prepared(drop_near_copies)),
    ("decontamination", _prepared(drop_contaminated)),
    ("personal_data", _prepared(redact_personal_data)),
    ("mix", _prepared(mix_sources)),
]
# The models and the joins of near copies have no counterpart in SQL; tests compare the stages
# with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
