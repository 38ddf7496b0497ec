"""Mixing sources to target weights.

Words are summed per source, a target is derived for each source, and each document is
taken floor(rate) times plus once more with the probability of the rate's fraction, decided
by a hash of its id. rate = target / size of the source.

Null and repeated rows: a null text has no words, null sources form one source (last in
order), rows with the same id are decided alike. A source without words has target 0 and is
not taken. Empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.llm.frames import col, free_name, unit_hash
from tradeloom.sources.scratch import materialize

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
SEED = 5


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_sizes(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """`source`, `source_size`: one row per source; tasks add up their own rows first."""
    return docs.groupBy(col(source).alias("source")).agg(F.sum(word_count(col(text))).alias("source_size"))


def with_weights(sizes: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """Adds `weight`: the weights in turn along the sources by code point, null last.

    The sources are ranked in slices of a range partitioning; only the slices' row counts
    are added up in one place.
    """
    order = F.col("source").asc_nulls_last()
    sliced = materialize(
        sizes.repartitionByRange(order).withColumn("slice", F.spark_partition_id()), "mix-sources"
    )
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = sliced.groupBy("slice").agg(F.count("*").alias("n")).select(
        "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    place = F.row_number().over(Window.partitionBy("slice").orderBy(order)) - 1 + F.col("before")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    return sliced.join(before, "slice").select(
        "source", "source_size", F.element_at(turn, (place % len(weights) + 1).cast("int")).alias("weight")
    )


def with_targets(weighted: DataFrame, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Adds `target`: by weight, at most `cap` times the source, the excess shared again.

    Each round fixes the sources that reach their limit at the present words per weight and
    shares what is left among the others. Rounds exchange three sums with the driver.
    """
    weighted = materialize(weighted, "mix-weights")
    limit = F.col("source_size") * cap
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    fixed, level = 0.0, 0.0
    for _ in count():
        full = limit <= F.lit(level) * F.col("weight")
        row = weighted.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if row["open"] == 0 or (level > 0 and row["fixed"] == fixed):
            break
        fixed = row["fixed"]
        level = (share * total - fixed) / row["open"]
        if level <= 0:
            break
    return weighted.withColumn("target", F.least(limit, F.lit(float(level)) * F.col("weight")))


def targets(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """`source`, `source_size`, `weight`, `target`, one row per source."""
    return with_targets(with_weights(source_sizes(docs, source, text), weights), share, cap)


def mix(
    docs: DataFrame,
    plan: DataFrame,
    seed: int = SEED,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    keep: Sequence[str] | None = None,
    name: str = "mix",
) -> DataFrame:
    """The columns `keep` (all by default) and a struct `name`: size, source_size, target, copies.

    The plan has a row per source and is joined as its size allows; a hot source is split by
    the engine's skew join, as the rows need not meet afterwards.
    """
    keep = docs.columns if keep is None else keep
    key, size, known = free_name(docs, "mix_source"), free_name(docs, "mix_size"), free_name(docs, "mix_known")
    sized = docs.select(
        *[col(c) for c in keep], col(source).alias(key), word_count(col(text)).alias(size),
        unit_hash(seed, col(doc_id)).alias(known),
    )
    plan = plan.select(F.struct("source", "source_size", "target").alias(free_name(docs, "mix_plan")))
    planned = F.col(plan.columns[0])
    rate = F.when(planned.source_size > 0, planned.target / planned.source_size).otherwise(F.lit(0.0))
    extra = (col(known) < rate - F.floor(rate)).cast("long")
    taken = F.struct(
        col(size).alias("size"), planned.source_size.alias("source_size"), planned.target.alias("target"),
        (F.floor(rate) + extra).alias("copies"),
    )
    return sized.join(plan, col(key).eqNullSafe(planned.source), "left").select(
        *[col(c) for c in keep], taken.alias(name)
    )


def emit(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each row as often as it is taken, with `copy` from 1 on."""
    taken = free_name(docs, "mix")
    copies = F.col(taken).copies
    return mix(docs, targets(docs, **settings), name=taken).select(
        *[col(c) for c in docs.columns],
        F.explode(F.when(copies > 0, F.sequence(F.lit(1).cast("long"), copies))).alias(free_name(docs, "copy")),
    )


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix(docs, targets(docs), keep=["doc_id"]).select(
        "doc_id", "mix.size", "mix.source_size", "mix.target",
        (F.col("mix.size") * F.col("mix.copies")).alias("taken"), "mix.copies",
    )
