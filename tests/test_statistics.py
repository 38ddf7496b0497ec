"""Quantiles, outliers, transforms, profile."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeloom.operators import quality, quantiles, transforms
from tradeloom.operators.ordered import running_count
from tradeloom.operators.quantiles import exact_quantiles
from tradeloom.plans import rollups


def test_quantiles_equal_numpy(spark):
    rng = random.Random(7)
    rows = [(k, rng.choice([1.0, 2.5, rng.gauss(0, 9)])) for k in "aab" for _ in range(500)]
    rows += [("c", 4.0), ("d", None)]
    frame = spark.createDataFrame(rows, "k string, v double").repartition(6)
    got = {r.k: r for r in exact_quantiles(frame, ["k"], ["v"], {"q1": 0.25, "half": 0.5, "top": 1.0}).collect()}
    assert set(got) == {"a", "b", "c"}
    for k in got:
        values = [v for key, v in rows if key == k]
        assert got[k].n == len(values)
        for name, p in (("q1", 25), ("half", 50), ("top", 100)):
            assert got[k][name] == pytest.approx(np.percentile(values, p), abs=1e-12)


def test_quantiles_of_many_slices(spark):
    """One key over several slices, a third of the rows being one value."""
    frame = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, 5000.0).otherwise(F.col("id").cast("double")).alias("v")
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        row = exact_quantiles(frame, [], ["v"], {"q": 0.37}).first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    values = [5000.0 if i % 3 == 0 else float(i) for i in range(30000)]
    assert row.q == pytest.approx(np.percentile(values, 37), abs=1e-9)


def outlier_frame(spark):
    """20 rows: `over` has 3 outliers, `under` 1, `flat` is constant, `holes` has 2 among 8 values."""
    rows = []
    for i in range(20):
        over = 1000.0 + i if i < 3 else float(i)
        under = 1000.0 if i == 0 else float(i)
        holes = None if i >= 8 else (500.0 if i < 2 else 10.0 + i / 10)
        rows.append((i, over, under, 7.0, holes))
    return spark.createDataFrame(rows, "id int, over double, under double, flat double, holes double")


COLUMNS = ["over", "under", "flat", "holes"]


def test_iqr_threshold(spark):
    got = {r.column_name: r for r in quality.iqr_outliers(outlier_frame(spark), COLUMNS, threshold=0.1).collect()}
    assert {c: got[c].outlier_count for c in COLUMNS} == {"over": 3, "under": 1, "flat": 0, "holes": 2}
    assert got["over"].outlier_share == pytest.approx(3 / 20)
    # Rows without a value count, which puts `holes` exactly on the threshold.
    assert got["holes"].row_count == 20 and got["holes"].outlier_share == 0.1
    assert {c: got[c].flagged for c in COLUMNS} == {"over": True, "under": False, "flat": False, "holes": True}


@pytest.mark.parametrize("method", ["cap", "log", "log_offset", "zscore", "zscore_pop"])
def test_transform_and_inverse(spark, method):
    frame = outlier_frame(spark)
    params = transforms.fit_outliers(frame, COLUMNS, method, threshold=0.1)
    fitted = {r.column_name: r for r in params.collect()}
    treated = transforms.apply_outliers(frame, params, COLUMNS, method)
    before = {r.id: r for r in frame.collect()}
    values = [r.over for r in before.values()]
    mean, std = np.mean(values), np.std(values, ddof=0 if method == "zscore_pop" else 1)
    for r in treated.collect():
        x = before[r.id].over
        expected = {
            "cap": min(max(x, fitted["over"].lower), fitted["over"].upper),
            "log": math.log1p(x),
            "log_offset": math.log(x),
            "zscore": (x - mean) / std,
            "zscore_pop": (x - mean) / std,
        }[method]
        assert r.over == pytest.approx(expected, abs=1e-9)
        assert r.under == before[r.id].under and r.flat == 7.0
        assert (r.holes is None) == (before[r.id].holes is None)
    if method != "cap":
        for r in transforms.undo(treated, params, COLUMNS, method).collect():
            assert r.over == pytest.approx(before[r.id].over, abs=1e-9)
            assert r.under == before[r.id].under


def test_unknown_method(spark):
    frame = outlier_frame(spark)
    with pytest.raises(ValueError):
        transforms.fit_outliers(frame, ["over"], "winsorise")


def test_profile(spark):
    rows = [("b", 1, True), ("a", 2, None), ("a", 2, False), ("b", None, False), (None, 5, False), ("c", 9, True)]
    rows += [(v, 0, None) for v in "defg"]
    frame = spark.createDataFrame(rows, "t string, n int, f boolean")
    got = {r.column_name: r for r in quality.profile(frame).collect()}
    assert got["t"].common_values == "a|b|c|d|e" and got["t"].unique_values == 7 and got["t"].null_count == 1
    assert (got["n"].min_value, got["n"].max_value, got["n"].common_values) == (0.0, 9.0, None)
    assert got["f"].common_values == "false|true" and got["f"].null_count == 5
    assert all(r.row_count == 10 for r in got.values())
    rough = {r.column_name: r.unique_values for r in quality.profile(frame, approximate=True).collect()}
    assert rough == {"t": 7, "n": 5, "f": 2}


@pytest.mark.parametrize("few", [1000, 3])
def test_profile_equals_plain_counts(spark, monkeypatch, few):
    """Near-unique texts, ties at the last place, a hot value, NULLs only, both zeros and NaN."""
    monkeypatch.setattr(quality, "FEW_VALUES", few)
    rng = random.Random(few)
    rows = [
        (f"id{i * 7919 % 1000:04d}" * 30, rng.choice(["x", "y", None, *"abcdefgh"]), f"p{i // 2 % 400:03d}" if i % 9 else "hot", None,
         rng.choice([0.0, -0.0, 1.5, float("nan")]), rng.random() < 0.3)
        for i in range(1000)
    ]
    rows += [("twice", None, None, None, None, None)] * 2
    schema = "unique string, tied string, pairs string, nothing string, number double, flag boolean"
    got = {r.column_name: r for r in quality.profile(spark.createDataFrame(rows, schema)).collect()}
    for i, name in enumerate(["unique", "tied", "pairs", "nothing", "number", "flag"]):
        values = [r[i] for r in rows if r[i] is not None]
        assert got[name].row_count == 1002 and got[name].null_count == 1002 - len(values)
        if name == "number":
            assert got[name].unique_values == 3
            continue
        counts = Counter(str(v).lower() if name == "flag" else v for v in values)
        assert got[name].unique_values == len(counts)
        want = [v for v, _ in sorted(counts.items(), key=lambda e: (-e[1], e[0]))[:5]]
        assert got[name].common_values == ("|".join(want) if want else None)


def test_profile_shuffles_hashes_not_texts(spark):
    wide = spark.range(2000).select(F.repeat(F.col("id").cast("string"), 200).alias("text"))
    hashed = quality._hashed(wide, ["text"])
    assert hashed.columns == ["column_name", "_a", "_b"]
    assert quality.profile(wide).first().common_values == "|".join(sorted(str(i) * 200 for i in range(2000))[:5])


def test_small_checks(spark):
    frame = spark.createDataFrame([(1, "x"), (1, "x"), (1, "x"), (-2, None)], "n int, s string")
    assert quality.duplicate_rows(frame).first()[0] == 2
    assert {r[0]: r[1] for r in quality.null_counts(frame).collect()} == {"n": 0, "s": 1}
    assert {r[0]: r[1] for r in quality.negative_counts(frame, ["n"]).collect()} == {"n": 1}
    dates = spark.createDataFrame([("2024-01-02",), ("soon",), (None,)], "d string")
    assert tuple(quality.invalid_dates(dates, "d").first()) == (3, 1, 1)


def test_medians_of_hot_tickers(spark, monkeypatch):
    """Groups counted whole and bracketed by a sketch agree, and with numpy."""
    rng = random.Random(2)
    cents = lambda a, b: round(rng.uniform(a, b), 2)
    rows = [("hot" if i % 3 else f"t{i % 9}", cents(1, 9), rng.randrange(1, 50), cents(1, 900)) for i in range(600)]
    fact = spark.createDataFrame(
        rows, "stock_ticker string, stock_price double, quantity bigint, total_trade_amount double"
    )
    for accuracy in (10_000, 200, 40):
        monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
        got = {r.stock_ticker: r for r in rollups.stock_stats(fact).collect()}
        for t in {r[0] for r in rows}:
            assert got[t].stock_price_median == pytest.approx(np.median([r[1] for r in rows if r[0] == t]))
            assert got[t].quantity_median == pytest.approx(np.median([r[2] for r in rows if r[0] == t]))


@pytest.mark.parametrize("accuracy", [20, 100, 1000])
def test_bracketed_quantiles_equal_numpy(spark, monkeypatch, accuracy):
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    rng = random.Random(accuracy)
    values = [float(rng.choice([rng.randrange(50), rng.gauss(0, 1)])) for _ in range(4000)]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    probs = {"low": 0.0, "a": 0.01, "b": 0.37, "c": 0.5, "d": 0.99, "top": 1.0}
    row = exact_quantiles(frame, [], ["v"], probs).first()
    for name, p in probs.items():
        assert row[name] == pytest.approx(np.percentile(values, 100 * p), abs=1e-12)


def test_quantiles_of_a_hot_key_and_many_small_ones(spark):
    """One key holds a third of all rows, over several slices; 100 000 others have two each."""
    hot = spark.range(100_000).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % 100_003).cast("double").alias("v"))
    small = spark.range(200_000).select(
        (F.col("id") % 100_000).cast("string").alias("k"), F.col("id").cast("double").alias("v")
    )
    nulls = spark.range(5).select(F.lit(None).cast("string").alias("k"), F.col("id").cast("double").alias("v"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = exact_quantiles(hot.union(small).union(nulls), ["k"], ["v"], {"q": 0.25, "half": 0.5}).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    got = {r.k: r for r in rows}
    assert len(rows) == len(got) == 100_002
    values = [i * 7919 % 100_003 for i in range(100_000)]
    assert (got["hot"].n, got["hot"].half) == (100_000, np.percentile(values, 50))
    assert got["hot"].q == np.percentile(values, 25)
    assert (got[None].n, got[None].half) == (5, 2.0)
    for k in ("0", "77", "99999"):
        assert (got[k].n, got[k].q, got[k].half) == (2, int(k) + 25_000, int(k) + 50_000)


def test_running_counts_of_cut_keys(spark):
    """Keys over many slices, keys at the borders, single rows and a NULL key."""
    rng = random.Random(3)
    rows = [(k, i, rng.randrange(1, 9)) for k, n in [("a", 1), ("b", 900), ("c", 3), (None, 200), ("d", 500)] for i in range(n)]
    frame = spark.createDataFrame(rows, "k string, at int, n int").repartition(5)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.k, r["at"]): (r.upto, r.total) for r in running_count(frame, ["k"], "at", "n", "upto").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(got) == len(rows)
    for key in {r[0] for r in rows}:
        upto, total = 0, sum(n for k, _, n in rows if k == key)
        for k, i, n in rows:
            if k == key:
                upto += n
                assert got[k, i] == (upto, total)
