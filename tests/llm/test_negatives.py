import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tradeloom.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label long"


def units(v):
    return [math.floor(256 * x) for x in v]


def usable(row):
    i, v, label = row
    if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
        return False
    return sum((256.0 * x) * (256.0 * x) for x in v) < 2**62


def plain(rows, every=100, positives=5, kept=5):
    rows = [(i, units(v), label) for i, v, label in filter(usable, rows)]
    out = []
    for i, v, label in rows:
        if i % every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w)), j, c) for j, w, c in rows if len(w) == len(v)
        )
        good = [(s, j) for s, j, c in scored if c == label and j != i][:positives]
        for s, j in good:
            window = [(t, k) for t, k, c in scored if c != label and 80 * -s <= 100 * -t <= 100 * -s][:kept]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k) in enumerate(window, 1)]
    return sorted(out)


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in negatives.hard_negatives(frame, **options).collect())


def clustered(n, dim, seed, labels=3):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(5, dim))
    out = []
    for i in range(n):
        v = centers[rng.integers(5)] + rng.normal(size=dim) * rng.choice([0.01, 0.2, 1.0])
        out.append((i, [float(x) for x in v], int(rng.integers(labels))))
    return out


@pytest.mark.parametrize("page, fan, query_bytes", [(64, 16, 32 << 20), (3, 2, 600)])
def test_equal_to_all_pairs(spark, monkeypatch, page, fan, query_bytes):
    monkeypatch.setattr(negatives, "FAN", fan)
    monkeypatch.setattr(negatives, "QUERY_BYTES", query_bytes)
    monkeypatch.setattr(negatives.tiles, "__defaults__", (page,))
    rows = clustered(400, 6, 1)
    assert found(spark, rows, every=50) == plain(rows, every=50)


def test_ties_repeated_rows_and_hot_vectors(spark):
    rng = random.Random(3)
    grid = [[rng.choice([-1.0, 0.0, 0.5]) for _ in range(2)] for _ in range(150)]
    rows = [(i, v, rng.randrange(2)) for i, v in enumerate(grid)]
    rows += [(200 + i, [0.5, 0.5], i % 2) for i in range(120)]  # one vector many times
    rows += rows[:30] + rows[200:210]  # repeated rows
    got, want = found(spark, rows, every=10), plain(rows, every=10)
    # Rows that are alike in all but their repetition may stand for one another.
    assert got == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (None, [1.0, 1.0], 1), (100, None, 1), (200, [1.0, None], 1), (300, [1.0, nan], 1), (400, [inf, 1.0], 1),
        (500, [1.0, 1.0], None), (600, [], 1), (700, [1e300, 1.0], 1),
        (0, [1.0, 1.0], 1), (1, [1.0, 0.9], 1), (2, [0.9, 0.9], 2), (3, [-1.0, 0.0], 1), (4, [0.0, 0.0], 2),
        (1000, [1e6, -1e6], 3), (1001, [1e6, -1e6 - 0.01], 3), (1002, [1e6 - 0.01, -1e6], 4), (1003, [9e5, -9e5], 4),
        (1100, [2e6] * 3, 3), (1101, [2e6] * 3, 3), (1102, [2e6, 2e6, 2e6 - 0.004], 4),
        (-100, [1.0, 1.0, 1.0, 0.0], -7), (-1, [1.0, 1.0, 1.0, 0.0], -7), (-2, [1.0, 1.0, 0.9, 5.0], 0),
    ]
    got = found(spark, rows)
    assert got == plain(rows)
    assert {r[0] for r in got} >= {0, 1000, 1100, -100}


def test_no_rows_and_other_columns(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 1)]) == []
    frame = spark.createDataFrame(
        [(0, [1.0], 1, 5, 6), (1, [1.0], 1, 5, 6), (2, [0.9], 2, 5, 6)], SCHEMA + ", score int, key int"
    )
    assert [tuple(r) for r in negatives.hard_negatives(frame).collect()] == [(0, 1, 1, 2, 65536, 256 * 230)]


def test_pages_hold_all_rows_in_tight_boxes():
    rng = np.random.default_rng(0)
    rows = np.floor(rng.normal(size=(1000, 3)) * 256)
    pages = negatives.tiles(rows, 16)
    assert sorted(np.concatenate(pages)) == list(range(1000))
    assert max(map(len, pages)) <= 16
    packed = np.mean([np.ptp(rows[p], axis=0).prod() for p in pages])
    scattered = np.mean([np.ptp(rows[i : i + 16], axis=0).prod() for i in range(0, 992, 16)])
    assert packed < scattered / 10


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)
    rows = np.floor(rng.normal(size=(2000, 2)) * 256)
    pages = negatives.tiles(rows, 32)
    zeros = [np.zeros(len(p), "<i8").tobytes() for p in pages]
    tree = negatives.Tree.over(2, zeros, zeros, [rows[p].astype("<f8").tobytes() for p in pages])
    q = rows[:5]
    lower, upper = next(tree.bounds(q))
    scores = tree.rows @ q.T
    for i, (a, b) in enumerate(zip(tree.first, tree.first[1:])):
        assert (scores[a:b] >= lower[i]).all() and (scores[a:b] <= upper[i]).all()
    for j in range(5):
        kth = np.sort(scores[:, j])[-5]
        assert (upper[:, j] >= kth).mean() < 0.5


class Counted(np.ndarray):
    """Rows whose matrix products are counted."""

    products = 0

    def __matmul__(self, other):
        Counted.products += 1
        return np.asarray(self) @ np.asarray(other)

    def __rmatmul__(self, other):
        Counted.products += 1
        return np.asarray(other) @ np.asarray(self)


@pytest.mark.parametrize("same", [True, False])
def test_queries_share_products_where_boxes_exclude_nothing(monkeypatch, same):
    """Directions spread over 64 coordinates: every query meets nearly every page."""
    rng = np.random.default_rng(5)
    rows = np.floor(rng.normal(size=(4000, 64)) * 256)
    labels = rng.integers(3, size=len(rows))
    pages = negatives.tiles(rows)
    parts = [[x[p].astype(kind).tobytes() for p in pages] for x, kind in ((np.arange(4000), "<i8"), (labels, "<i8"), (rows, "<f8"))]
    batch = pa.RecordBatch.from_arrays([pa.array([64] * len(pages), pa.int32()), *map(pa.array, parts)], schema=negatives.PAGES)
    # Five windows of each of 40 anchors.
    asked = [(key, low) for key in range(40) for low in (-(1 << 40), 0, 100_000, 200_000, 1 << 40)]
    own = np.array([key * 100 for key, _ in asked])
    table = pa.table({
        "key": [key for key, _ in asked], "vec_id": own, "label": labels[own], "dim": [64] * len(asked),
        "vector": [rows[i] for i in own], "low": [low for _, low in asked], "high": [low + (1 << 41) for _, low in asked],
    })

    class Sent:
        value = negatives.grouped(table, same, 5)

    exact_with = negatives.Tree.exact_with
    monkeypatch.setattr(negatives.Tree, "exact_with", lambda t, q: (lambda r, v: (r.view(Counted), v))(*exact_with(t, q)))
    Counted.products = 0
    found = pa.Table.from_batches(negatives.searcher(Sent)(iter([batch]))).to_pylist()
    want = []
    for (key, low), i in zip(asked, own):
        scores = (rows @ rows[i]).astype(int)
        good = [j for j in range(4000) if scores[j] >= low and (labels[j] == labels[i]) == same and not (same and j == i)]
        want += [(key, low, scores[j], j) for j in sorted(good, key=lambda j: (-scores[j], j))[:5]]
    assert sorted((f["key"], f["low"], f["score"], f["found_id"]) for f in found) == sorted(want)
    # A product per query and page would be about 200 * 63.
    assert Counted.products < 200
