"""Connected components, in tasks by arrays and across the cluster by stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.sources.scratch import materialize


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node that each of n nodes reaches over the links (a, b)."""
    root = np.arange(n)
    while len(a):
        # Roots only are moved, each below the lowest root it is linked with.
        np.minimum.at(root, np.maximum(root[a], root[b]), np.minimum(root[a], root[b]))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def _forest(batches):
    """The links of a task as links to the smallest node that each node reaches over them."""
    both = [np.zeros((2, 0), np.int64)]
    for batch in batches:
        both.append(np.stack([batch.column("u").to_numpy(), batch.column("v").to_numpy()]))
    ends = np.concatenate(both, axis=1)
    nodes, place = np.unique(ends, return_inverse=True)
    place = place.reshape(ends.shape)
    root = local_roots(len(nodes), place[0], place[1])
    some = root != np.arange(len(nodes))
    yield pa.record_batch({"u": pa.array(nodes[some]), "v": pa.array(nodes[root[some]])})


def components(links: DataFrame, a: str = "a", b: str = "b", label: str = "components") -> DataFrame:
    """`id`, `component`: the smallest id reachable, for each id of a link between two ids.

    Tasks first reduce their own links to a forest of at most one link per node. Then large and
    small stars alternate until nothing changes. A round takes the minimum per node, which tasks
    prepare on their own rows, and joins it back; a node with very many links is split by the
    engine's skew join. Only a count and a sum reach the driver.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v")
    edges = materialize(edges.mapInArrow(_forest, "u long, v long").distinct(), label)
    state = None
    while True:
        row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("sum")).first()
        if not row["n"] or (row["n"], row["sum"]) == state:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        state = (row["n"], row["sum"])
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.union(lowest.select("u", F.col("m").alias("v"))).distinct(), label)
