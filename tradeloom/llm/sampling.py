"""Bounded samples of labelled rows for fitting models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.frames import unit_hash


def per_class_sample(rows: DataFrame, label: str, key: str, bound: int, seed: int) -> DataFrame:
    """About `bound` rows of each value of `label`, chosen by a hash of `key`.

    Classes with at most `bound` rows are taken whole. The expected number of rows is at most
    `bound` times the number of classes, whatever the size of the input. No class is sorted
    or gathered: rows are counted per class, then compared with the class's share.
    """
    shares = rows.groupBy(label).agg(F.count("*").alias("n")).select(
        F.col(label).alias("class"), F.least(F.lit(1.0), F.lit(float(bound)) / F.col("n")).alias("share")
    )
    # One row per class; classes are the values a model learns to tell apart.
    return rows.join(F.broadcast(shares), rows[label] == shares["class"]).where(
        unit_hash(seed, F.col(key)) < F.col("share")
    ).drop("class", "share")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, target: str, bound: int, seed: int, columns: Sequence[str] = ("text",)
) -> DataFrame:
    """`columns` of a sample of the labelled documents with `target` (0 or 1) as `label`.

    The sample of ids is bounded by `bound` rows of each label, so it is broadcast and the
    texts are not shuffled. Rows of `labels` that repeat an id count once, by their largest
    label.
    """
    known = labels.where(F.col(target).isNotNull()).groupBy("doc_id").agg(F.max(target).alias("label"))
    chosen = per_class_sample(known, "label", "doc_id", bound, seed).withColumnRenamed("doc_id", "chosen_id")
    return docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("chosen_id")).select("doc_id", "label", *columns)
