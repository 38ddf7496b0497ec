"""Exact quantiles (linear interpolation) of columns too large for one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.operators.ordered import running_count
from tradeloom.sources.scratch import materialize

# A sketch of ACCURACY misplaces a rank by n / ACCURACY at most; brackets are MARGIN times
# as wide, so a bracket of n >= ACCURACY / MARGIN rows also holds the neighbouring ranks.
ACCURACY, MARGIN = 10_000, 4


def exact_quantiles(
    frame: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Mapping[str, float]
) -> DataFrame:
    """One row per key and column: keys, column_name, n and one column per prob.

    Equal values of a group are counted, by the tasks first; the counts are ranked along one
    range partitioning by group and value, so a task holds a slice of them, be it part of a
    large group or many small ones. Quantiles of whole columns are few, so a sketch of each
    column leaves only the values next to them to be counted one by one. NULL values are left
    out, NULL keys are a group.
    """
    group = [*keys, "column_name"]
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]
    long = frame.select(*keys, F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())
    counts = long.groupBy(*group, "value").agg(F.count("*").alias("n")) if keys else _near(long, probs)
    ranked = running_count(counts, group, "value", "n", "upto", total="size")

    def at(rank: Column) -> Column:
        """Smallest value with more than `rank` values up to and including it."""
        return F.min(F.when(F.col("upto") > rank, F.col("value")))

    picks = []
    for name, p in probs.items():
        position = F.lit(float(p)) * (F.col("size") - 1)
        picks += [at(F.floor(position)).alias(f"_{name}_low"), at(F.ceil(position)).alias(f"_{name}_high")]
    ends_of = ranked.groupBy(*group, "size").agg(*picks)

    def interpolated(name: str, p: float) -> Column:
        position = F.lit(float(p)) * (F.col("size") - 1)
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        return low + (high - low) * (position - F.floor(position))

    return ends_of.select(
        *group, F.col("size").alias("n"), *[interpolated(n, p).alias(n) for n, p in probs.items()]
    )


def _near(long: DataFrame, probs: Mapping[str, float]) -> DataFrame:
    """`column_name`, `value`, `n`: counts of the values around the quantiles, and of those between.

    A first scan brackets each quantile of a column by a sketch of bounded size. A second one
    counts the values inside the brackets one by one and those between them together. Columns
    with fewer values than the sketch is exact for are counted whole.
    """
    reach = MARGIN / ACCURACY
    ends = [min(max(p + side * reach, 0.0), 1.0) for p in probs.values() for side in (-1, 1)]
    brackets = long.groupBy("column_name").agg(
        F.count("*").alias("_n"), F.percentile_approx("value", ends, ACCURACY).alias("_ends")
    )
    # One row per column.
    brackets = F.broadcast(materialize(brackets, "brackets").withColumnRenamed("column_name", "_column"))
    value, bounds = F.col("value"), F.col("_ends")
    inside = reduce(
        lambda a, b: a | b,
        [value.between(bounds[2 * i], bounds[2 * i + 1]) for i in range(len(probs))],
        F.col("_n") < ACCURACY / MARGIN,
    )
    between = F.size(F.filter(bounds, lambda end: end < value))
    return (
        long.join(brackets, F.col("column_name") == F.col("_column"))
        .groupBy("column_name", F.when(inside, value).alias("_value"), F.when(~inside, between).alias("_between"))
        .agg(F.count("*").alias("n"), F.min("value").alias("value"))
        .drop("_value", "_between")
    )
