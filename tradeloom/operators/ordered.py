"""Order-dependent building blocks that never put a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.sources.scratch import materialize


def running_count(
    frame: DataFrame, keys: Sequence[str], order: str, weight: str, out: str, total: str = "total"
) -> DataFrame:
    """Running sum of `weight` inside each key along `order`, split across tasks.

    Adds the running sum as `out` and the key's whole sum as `total`.

    (keys, order) must be unique. The rows are range-partitioned and written, each
    with the number of its slice. A key that lies in one slice is done there; a slice
    that holds part of a key adds the sum of the key's earlier slices to its own. The
    written table fixes the slices, so all uses below, and any retry, see the same ones.
    """
    sliced = frame.repartitionByRange(*keys, order).withColumn("_slice", F.spark_partition_id())
    sliced = materialize(sliced, "slices")
    inside = Window.partitionBy(*keys, "_slice")
    before = inside.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    parts = cut_keys(sliced, keys).groupBy(*keys, "_slice").agg(F.sum(weight).alias("_part"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(
        *[F.col(c).alias(f"_c_{c}") for c in [*keys, "_slice"]],
        F.coalesce(F.sum("_part").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_part").over(Window.partitionBy(*keys)).alias("_whole"),
    )
    match = [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in [*keys, "_slice"]]
    summed = sliced.withColumns({"_upto": F.sum(weight).over(before), "_all": F.sum(weight).over(inside)})
    # At most two rows per slice.
    return summed.join(F.broadcast(carried), match, "left").select(
        *frame.columns,
        F.coalesce("_whole", "_all").alias(total),
        (F.coalesce("_before", F.lit(0)) + F.col("_upto")).alias(out),
    )


def cut_keys(sliced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of keys that lie in more than one slice of a range partitioning along the keys.

    Such a key is the first or the last one of each of its slices, so there are fewer of
    them than slices.
    """
    listed = cut_key_list(sliced, keys)
    return sliced.join(F.broadcast(listed), [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys], "left_semi")


def cut_key_list(sliced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys themselves, as `_k_` and their names."""
    key = F.struct(*keys)
    ends = sliced.groupBy("_slice").agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    listed = ends.select(F.explode(F.array_distinct(F.array("_first", "_last"))).alias("_key"))
    cut = listed.groupBy("_key").agg(F.count("*").alias("_slices")).filter("_slices > 1")
    return cut.select(*[F.col(f"_key.{c}").alias(f"_k_{c}") for c in keys])
