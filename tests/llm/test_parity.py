import random

import numpy as np
import pytest
from brute import near_classes, reach, shingle_set
from pyspark.sql import functions as F

from tradeloom.llm import parity
from tradeloom.llm.components import components, local_roots
from tradeloom.llm.texts import shingles, slices, words

SMALL = "/root/testdata/sf0.001"


def corpus(seed=1, n=150):
    rng = random.Random(seed)
    line = [f"common{k}" for k in range(30)]
    base, out = [], {}
    for i in range(n):
        if base and rng.random() < 0.6:
            w = list(rng.choice(base))
            for _ in range(rng.randint(0, max(1, len(w) // 12))):
                k = rng.randrange(len(w)) if w else 0
                w[k : k + 1] = rng.choice([[], ["new"], [f"v{rng.randint(0, 99)}", "x"]])
        else:
            w = [f"w{rng.randint(0, 300)}" for _ in range(rng.choice([0, 1, 3, 5, 6, 8, 12, 40, 200]))]
        if rng.random() < 0.4:
            w = w + line
        base.append(w)
        out[i] = rng.choice([" ", "\n", "\t "]).join(x.upper() if rng.random() < 0.1 else x for x in w)
    return out


@pytest.mark.parametrize("small, block, seed", [(8, 512, 1), (2, 512, 2), (2, 3, 3)])
def test_classes_equal_all_pairs(spark, monkeypatch, small, block, seed):
    monkeypatch.setattr(parity, "SMALL", small)
    monkeypatch.setattr(parity, "BLOCK", block)
    texts = corpus(seed)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in parity.near_duplicates(frame).collect()}
    assert got == near_classes(texts)


def test_query_equals_all_pairs(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in parity.op9_ngram_jaccard(spark, SMALL).collect()}
    assert got == near_classes(texts)


def test_linked_sets_share_a_lane():
    """The pigeonhole, for pairs at the threshold of many sizes."""
    rng = np.random.default_rng(7)
    for size in [1, 2, 3, 4, 5, 7, 9, 15, 16, 40, 100, 333, 1000, 4000] * 4:
        a = np.unique(rng.integers(0, 1 << 54, size, dtype=np.uint64))
        common = a[: -(-3 * len(a) // 4)] if rng.random() < 0.5 else a[: max(1, int(len(a) * 0.9))]
        free = int(len(common) / 0.75) - len(a)
        b = np.unique(np.append(common, rng.integers(0, 1 << 54, max(0, free), dtype=np.uint64)))
        if not parity.linked(np.intersect1d(a, b).size, len(a), len(b)) or np.array_equal(a, b):
            continue
        d, sig = parity.lanes(np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b]), np.array([len(a), len(b)]))
        assert np.intersect1d(sig[d == 0], sig[d == 1]).size
        assert parity.distance(parity.bits(a, len(a)), parity.bits(b, len(b))) <= parity.difference(len(a), len(b))


def test_shingle_sets_have_the_sizes_of_plain_ones():
    import pyarrow as pa

    texts = ["", "a", "a b c d", "A b c d e", "a a a a a a a", "x  y z\x1fq   w v u t", "É é e f g h i"] * 3
    for part in slices(pa.array([None, *texts])):
        doc, value = shingles(words(part), len(part))
        assert np.bincount(doc, minlength=len(part)).tolist() == [0] + [len(shingle_set(t)) for t in texts]


def test_nulls_repeated_ids_and_one_kept(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(3, a), (1, a), (1, a), (1, b), (5, b), (None, a), (7, None), (8, ""), (9, "  ")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"component_id": F.lit(0), "place": F.lit(1), "gone_id": F.lit(2)})
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in parity.near_duplicates(frame).collect())
    assert got == [(0, 2, 1), (1, 2, 1), (1, 2, 1), (1, 2, 1), (3, 2, 1), (5, 2, 1), (7, 0, 7), (8, 0, 8), (9, 0, 9)]
    kept = parity.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 7, 8, 9]
    assert parity.near_duplicates(frame.limit(0)).collect() == [] and parity.keep_one(frame.limit(0)).collect() == []


def test_rows_that_stay_are_not_shuffled_for_the_removal(spark, monkeypatch):
    """Rows in no slot of a removed or repeated id pass by the joins; the others are joined by id."""
    monkeypatch.setattr(parity, "BITMAP", 1 << 15)  # some slots hold several ids
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = [(i, f"a{i // 2} b{i // 2} c d e f") for i in range(0, 1000)] + [(i, f"u{i} v{i} w x y z") for i in range(1000, 5000)]
        texts += [(None, "p q r s t u"), (None, None), (2000, "again a b c d e"), (2000, None)]
        frame = spark.createDataFrame(texts, "`doc.id` long, text string").withColumn("slot_bits", F.lit(1))
        kept = parity.keep_one(frame, "doc.id")
        assert kept.columns == frame.columns
        got = sorted((r[0], r.text or "") for r in kept.collect() if r[0] is not None)
        assert got == sorted([*texts[:1000:2], *(t for t in texts[1000:5000] if t[0] != 2000), (2000, "again a b c d e")])
        assert sorted(r.text or "" for r in kept.collect() if r[0] is None) == ["", "p q r s t u"]

        ids = spark.range(0, 5000, 500).withColumnRenamed("id", "doc_id")
        free, met = parity.parted(frame, ids, "doc.id")
        assert "Exchange hashpartitioning" not in free._jdf.queryExecution().executedPlan().toString()
        found = [r[0] for r in met.collect()]
        assert set(range(0, 5000, 500)) <= set(found) and len(found) < 200
        assert free.count() + len(found) == len(texts)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def near_group(copies, strays, seed=4):
    """One text of 300 words with two changed in each copy, and strays that share half of it."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(300)]
    out = {}
    for i in range(copies):
        w = list(base)
        for _ in range(2):
            w[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
        out[i] = " ".join(w)
    for i in range(strays):
        out[copies + i] = " ".join(base[:150] + [f"s{i}_{k}" for k in range(150)])
    return out


def test_a_large_group_with_strays_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(parity, "BLOCK", 32)
    texts = near_group(300, 5)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in parity.near_duplicates(frame).collect()}
    assert got == near_classes(texts)


def test_rows_dealt_out_grow_with_the_group(spark, monkeypatch):
    """Members of a group's largest class are dealt out once for each block of the others."""
    monkeypatch.setattr(parity, "BLOCK", 50)
    dealt = {}
    for n in (500, 2000):
        members = spark.range(n).select(F.lit(1).alias("sig"), F.col("id").alias("member"))
        classes = spark.range(n - 5).select("id", F.lit(0).cast("long").alias("component"))
        sketches = spark.range(n).select(F.col("id").alias("key"), F.lit(100).alias("n"), F.lit(bytes(64)).alias("sketch"))
        rows = parity.mixed_groups(members, classes, sketches, 4).cache()
        dealt[n] = rows.count()
        met = rows.where("side = 0").select("member", "i", "j").join(
            rows.where("side = 1").select(F.col("member").alias("other"), "i", "j"), ["i", "j"]
        )
        assert met.select("member", "other").distinct().count() == 5 * n
    assert dealt[500] <= 2 * 500 and dealt[2000] <= 2 * 2000


def test_a_text_of_many_words(spark):
    long = " ".join(f"w{i % 70_000}" for i in range(200_000))
    rows = [(1, long), (2, long + " more"), (3, None), (4, long[: len(long) // 2])]
    got = {r.doc_id: r.component_id for r in parity.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: shingle_set(t) for i, t in rows}
    near = 100 * len(sets[1] & sets[4]) >= 75 * len(sets[1] | sets[4])
    assert got == {1: 1, 2: 1, 3: 3, 4: 1 if near else 4}


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.id: r.component for r in components(frame).collect()}
    ids = {i for pair in links for i in pair if pair[0] != pair[1]}
    assert got == {i: c for i, c in reach(ids, links[:-1]).items()}
    rng = np.random.default_rng(0)
    for n in (1, 5, 60, *[300] * 30):
        m = int(n * rng.choice([0.4, 0.7, 1.0, 2.0]))
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        assert local_roots(n, a, b).tolist() == list(reach(range(n), list(zip(a.tolist(), b.tolist()))).values())
