"""Near-duplicate vectors: an exact range join over cells around pivots.

Vectors of one label are compared by cosine. Unit vectors are near in angle exactly if they
are near in distance, a metric, so links are pairs within `radius`. Equal vectors are one
vector with a number of copies. Each label of two vectors or more has pivots, about log2 of its
vectors, taken farthest first from a sample; each vector's home is the cell of its nearest
pivot. By the triangle inequality a vector can only be within `radius` of one whose home is
cell j if its distance to pivot j exceeds the distance to its own pivot by at most 2 * radius;
it is copied to these cells (less those that the bisecting plane rules out), and cells join on
their own: home vectors with all vectors of the cell. Cells that are too large for a task, also
through one dense spot, are joined block by block.

Vectors that are null, empty, zero or hold null or non-finite components, or whose label or
id is null, link with nothing and are their own component. Vectors of different lengths do
not link. Repeated rows are vectors of their own and link as equal ones do. An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.components import components, local_roots
from tradeloom.llm.frames import unit_hash
from tradeloom.llm.texts import trim
from tradeloom.sources.scratch import materialize

COSINE = 0.98
SAMPLED = 8  # vectors a pivot is chosen from, about
CHUNK = 4096  # vectors that meet their label's pivots at once
BLOCK = 2000  # vectors of a block, on either side
CLOSE = 1e-9  # cosines that near the threshold are computed anew


def comparable(vector: Column) -> Column:
    """Whether a vector can be compared at all."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def pivots_of(sizes: DataFrame, vectors: DataFrame, seed: int = 6) -> DataFrame:
    """`label`, `dim`, `pivots`: flat arrays of unit vectors, ceil(log2(n)) of a label's n, at least 2.

    They are chosen from a sample by hash of SAMPLED times as many, and the label's first vector.
    """
    share = F.col("pivots") * SAMPLED / F.col("n")
    picked = vectors.join(sizes, ["label", "dim"]).where(
        (unit_hash(seed, F.col("node")) < share) | (F.col("node") == F.col("first"))
    )
    kind = vectors.schema["label"].dataType.simpleString()

    def farthest(key, table):
        rows = table.sort_by("node")
        dim, many = rows.column("dim")[0].as_py(), rows.column("pivots")[0].as_py()
        units = unit(rows.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dim))
        chosen, apart = [0], units @ units[0]  # the largest cosine to a chosen one
        while len(chosen) < min(many, len(units)):
            chosen.append(int(apart.argmin()))
            apart = np.maximum(apart, units @ units[chosen[-1]])
        return pa.table({"label": rows.column("label")[:1], "dim": rows.column("dim")[:1],
                         "pivots": pa.array([units[sorted(set(chosen))].ravel()], pa.list_(pa.float64()))})

    picked = picked.select("label", "dim", "node", "vector", "pivots")
    return picked.groupBy("label", "dim").applyInArrow(farthest, f"label {kind}, dim int, pivots array<double>")


def homes(units: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """For each vector its nearest pivot, and the cells it belongs to."""
    square = np.maximum(2.0 - 2.0 * (units @ pivots.T), 0.0)
    distance = np.sqrt(square)
    own = distance.argmin(axis=1)
    row = np.arange(len(units))
    apart = np.sqrt(np.maximum(2.0 - 2.0 * (pivots @ pivots.T), 1e-12))[own]
    near = (distance - distance[row, own][:, None] <= 2 * radius + CLOSE) & (
        (square - square[row, own][:, None]) / (2 * apart) <= radius + 1e-6
    )
    near[row, own] = True
    return own, near


def assign(radius: float):
    """A chunk of a label's vectors and its pivots to rows of cells; `home` marks the vector's own cell."""

    def cells(key, left, right):
        dim = key[1].as_py()
        pivots = right.column("pivots").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        units = unit(left.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dim))
        own, near = homes(units, pivots, radius)
        row, cell = np.nonzero(near)
        at, packed = pa.array(row), [u.tobytes() for u in units]
        out = {c: left.column(c).take(at) for c in ("label", "dim")}
        out |= {"cell": pa.array(cell.astype(np.int32)), "home": pa.array(cell == own[row])}
        out |= {c: left.column(c).take(at) for c in ("node", "copies")}
        return pa.table(out | {"unit": pa.array(packed, pa.binary()).take(at)})

    return cells


def cells_of(vectors: DataFrame, radius: float) -> DataFrame:
    """Each vector of a label of two or more in all its cells."""
    n = F.count("*")
    sizes = vectors.groupBy("label", "dim").agg(n.alias("n"), F.min("node").alias("first")).where("n > 1").withColumns(
        {"pivots": F.greatest(F.lit(2), F.ceil(F.log2("n"))).cast("int"), "chunks": F.ceil(F.col("n") / CHUNK).cast("int")}
    )
    sizes = materialize(sizes, "vector-labels")
    pivots = pivots_of(sizes.drop("chunks"), vectors)
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk")
    rows = vectors.join(sizes.select("label", "dim", "chunks"), ["label", "dim"]).select(
        "label", "dim", chunk, "node", "copies", "vector"
    )
    each = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    guides = pivots.join(sizes.select("label", "dim", "chunks"), ["label", "dim"]).select("label", "dim", each, "pivots")
    kind = vectors.schema["label"].dataType.simpleString()
    key = ["label", "dim", "chunk"]
    return rows.groupBy(*key).cogroup(guides.groupBy(*key)).applyInArrow(
        assign(radius), f"label {kind}, dim int, cell int, home boolean, node long, copies long, unit binary"
    )


def join_block(cosine: float):
    """Links between a block of home vectors (query) and a block of a cell's vectors."""

    def join(key, table):
        trim()
        query = table.column("query").to_numpy(zero_copy_only=False)
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        units = np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float64).reshape(len(node), -1)
        mine, other = np.flatnonzero(query), np.flatnonzero(~query)
        a, b = [], []
        for i in range(0, len(mine), 512):
            part = mine[i : i + 512]
            value = units[part] @ units[other].T
            x, y = np.nonzero(value >= cosine - CLOSE)
            value, x, y = value[x, y], part[x], other[y]
            for k in np.flatnonzero(np.abs(value - cosine) < CLOSE):
                u, v = units[x[k]], units[y[k]]
                value[k] = np.dot(u, v) / np.sqrt(np.dot(u, u) * np.dot(v, v))
            good = (value >= cosine) & (node[x] != node[y])
            a.append(x[good])
            b.append(y[good])
        a, b = np.concatenate([np.zeros(0, int), *a]), np.concatenate([np.zeros(0, int), *b])
        names, place = np.unique(node, return_inverse=True)
        links = np.zeros(len(names), np.int64)
        np.add.at(links, place[a], copies[b])
        root = local_roots(len(names), place[a], place[b])
        used = np.unique(np.concatenate([place[a], place[b]]))
        return pa.table({"node": pa.array(names[used], pa.int64()), "links": pa.array(links[used], pa.int64()),
                         "root": pa.array(names[root[used]], pa.int64())})

    return join


def links(cells: DataFrame, cosine: float = COSINE) -> DataFrame:
    """`node`, `links`, `root`: linked vectors with their number of links in a block, and the
    smallest vector of the block they reach. A pair is counted in the home cell of each side."""
    sizes = cells.groupBy("label", "dim", "cell").agg(
        F.ceil(F.sum(F.col("home").cast("int")) / BLOCK).cast("int").alias("home_blocks"),
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"),
    ).where("home_blocks > 0")
    placed = cells.join(sizes, ["label", "dim", "cell"]).withColumn("spot", F.abs(F.xxhash64("node") % 1_000_000_007))
    all_rows = placed.withColumns(
        {"j": (F.col("spot") % F.col("blocks")).cast("int"),
         "i": F.explode(F.sequence(F.lit(0), F.col("home_blocks") - 1)), "query": F.lit(False)}
    )
    home_rows = placed.where("home").withColumns(
        {"i": (F.col("spot") % F.col("home_blocks")).cast("int"),
         "j": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "query": F.lit(True)}
    )
    columns = ["label", "dim", "cell", "i", "j", "query", "node", "copies", "unit"]
    return home_rows.select(columns).union(all_rows.select(columns)).groupBy("label", "dim", "cell", "i", "j").applyInArrow(
        join_block(cosine), "node long, links long, root long"
    )


def near_duplicates(
    frame: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE
) -> DataFrame:
    """`vec_id`, `n_links`, `component_id`, `kept`: one row per row of `frame`."""
    rows = frame.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector")
    )
    can = comparable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    valid = rows.where(can)
    # A number for each different vector of a label: ids may repeat.
    equal = materialize(
        valid.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        .withColumns({"dim": F.size("vector"), "node": F.monotonically_increasing_id()}),
        "vector-copies",
    )
    radius = float(np.sqrt(2.0 - 2.0 * cosine))
    doubles = equal.withColumn("vector", F.col("vector").cast("array<double>"))
    cells = materialize(cells_of(doubles, radius), "vector-cells")
    found = materialize(links(cells, cosine), "vector-links")
    direct = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), label="vector-components")
    known = (
        equal.select("label", "vector", "rep", "copies", "node")
        .join(direct, "node", "left")
        .join(classes.withColumnRenamed("id", "node"), "node", "left")
        .withColumn("class", F.coalesce("component", "node"))
    )
    least = known.groupBy("class").agg(F.min("rep").alias("component_id"))
    known = known.join(least, "class")
    linked = valid.join(known.select("label", "vector", "links", "copies", "component_id"), ["label", "vector"]).select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    alone = rows.where(~can).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
