import numpy as np
import pyarrow as pa
import pytest
from brute import reach
from pyspark.sql import functions as F

from tradeloom.llm import vectors

SMALL = "/root/testdata/sf0.001"


def plain(rows):
    """vec_id -> (links, component); ids are unique."""
    good = {}
    for i, v, label in rows:
        if v is None or label is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        u = np.array(v, float)
        u = u / np.abs(u).max()
        good[i] = (label, u / np.sqrt(u @ u))
    links = [
        (a, b) for a, (l, u) in good.items() for b, (m, v) in good.items()
        if a != b and l == m and len(u) == len(v) and u @ v >= 0.98
    ]
    least = reach([r[0] for r in rows], links)
    return {i: (sum(a == i for a, _ in links), least[i]) for i, _, _ in rows}


def clusters(seed=0, dim=6, n=240):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, dim))
    out = []
    for i in range(n):
        c = centers[rng.integers(12)]
        v = c + rng.normal(size=dim) * rng.choice([0.0, 0.05, 0.2, 0.5])
        out.append((i, [float(x) for x in v * rng.choice([1, 3, 1e-3])], int(rng.integers(2))))
    return out


@pytest.mark.parametrize("chunk, block", [(4096, 2000), (50, 2000), (30, 7)])
def test_cells_and_blocks_equal_all_pairs(spark, monkeypatch, chunk, block):
    monkeypatch.setattr(vectors, "CHUNK", chunk)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = clusters()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(frame).collect()}
    assert got == plain(rows)


def test_labels_of_vectors_that_begin_alike(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CHUNK", 40)
    rows = [(i, [0.0] * 4 + v, i % 6) for i, v, _ in clusters(seed=1, dim=3, n=900)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(2, "vec_id")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(frame).collect()}
    assert got == plain(rows)


def test_pivots_grow_with_the_label_and_lie_apart(spark):
    """From the first pair on, without a limit; none for a vector on its own."""
    rng = np.random.default_rng(0)
    rows = [(label * 10_000 + i, [float(x) for x in rng.normal(size=4)], label, 1) for label, n in enumerate([1, 2, 3, 200, 3000]) for i in range(n)]
    frame = spark.createDataFrame(rows, "node long, vector array<double>, label int, copies long").withColumn("dim", F.lit(4))
    cells = vectors.cells_of(frame, 0.2).groupBy("label").agg(
        F.countDistinct("cell").alias("cells"), F.countDistinct("node").alias("nodes"), F.count_if("home").alias("homes"), F.count("*").alias("rows")
    )
    got = {r.label: r for r in cells.collect()}
    assert {k: r.cells for k, r in got.items()} == {1: 2, 2: 2, 3: 8, 4: 12}
    assert all(r.nodes == r.homes for r in got.values())
    assert got[4].rows < 6 * got[4].nodes  # most cells are ruled out


def test_cells_hold_all_neighbours():
    """Whatever is within the radius of a vector is in its home cell."""
    rng = np.random.default_rng(1)
    units = vectors.unit(rng.normal(size=(400, 3)))
    pivots = units[:9]
    own, near = vectors.homes(units, pivots, 0.2)
    apart = np.sqrt(np.maximum(2 - 2 * units @ units.T, 0))
    for i, j in zip(*np.nonzero(apart <= 0.2)):
        assert near[j, own[i]]
    assert near.sum() < near.size / 2


def test_repeated_ids_of_different_vectors(spark):
    """Counts belong to rows, not to ids, and labels do not mix."""
    rows = [(1, "a", [1.0, 0.0]), (1, "a", [0.0, 1.0]), (2, "a", [1.0, 0.001]), (3, "a", [0.001, 1.0]), (1, "b", [1.0, 0.0]), (7, "b", [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.near_duplicates(frame).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (7, 1, 1)]


def test_query_equals_all_pairs(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.op6_embedding_dedup(spark, SMALL).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in plain(rows).items()}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1),
            (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [], 1), (10, [1.0, 0.0], None), (11, [1.0, 0.0, 0.0], 1), (12, [1e300, 0.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n_links", F.lit("x"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(frame).collect()}
    want = {i: (0, i, True) for i in range(3, 12)} | {1: (2, 1, True), 2: (2, 1, False), 12: (2, 1, False)}
    assert got == want
    assert vectors.near_duplicates(frame.limit(0)).collect() == []


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(frame).collect())
    assert got == [(0, 0, None, False), (1, 1, 1, True), (1, 1, 1, True)]
