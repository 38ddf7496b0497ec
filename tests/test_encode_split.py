"""Label codes, round trip, split."""

import math

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import encode, split

# Sectors and industries of a small instrument list, in code order.
SECTORS = ["Consumer", "Energy", "Finance", "Healthcare", "Technology"]
INDUSTRIES = ["Asset Management", "Hardware", "Oil & Gas", "Pharmaceuticals", "Renewables", "Retail", "Software", "Utilities"]
WORKDAYS = ["Friday", "Monday", "Thursday", "Tuesday", "Wednesday"]


def fact(spark):
    rows = [
        (str(i), SECTORS[i % 5], INDUSTRIES[i % 8], WORKDAYS[i % 5], i % 7 == 0, False)
        for i in range(60)
    ]
    rows.append(("60", None, "retail", None, None, True))
    return spark.createDataFrame(
        rows,
        "transaction_id string, stock_sector string, stock_industry string, day_name string, "
        "is_weekend boolean, is_holiday boolean",
    )


def test_codes_are_ranks_in_binary_order(spark):
    rows = encode.fit_labels(fact(spark)).collect()
    codes = lambda c: {r.original_value: r.encoded_value for r in rows if r.column_name == c}
    assert codes("stock_sector") == {v: i for i, v in enumerate(SECTORS)}
    assert codes("stock_industry") == {v: i for i, v in enumerate([*INDUSTRIES, "retail"])}
    assert codes("day_name") == {v: i for i, v in enumerate(WORKDAYS)}
    assert codes("is_weekend") == {"0": 0, "1": 1} and codes("is_holiday") == {"0": 0, "1": 1}


def test_round_trip_and_nulls(spark):
    frame = fact(spark)
    lookups = encode.fit_lookups(frame.drop("transaction_id"))
    coded = encode.encode(frame, lookups)
    last = coded.filter("transaction_id = '60'").first()
    assert last.stock_sector is None and last.is_weekend is None and last.is_holiday == 1
    back = encode.decode(coded, lookups).select(frame.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, frame.collect()))


def test_unseen_and_stream_nulls(spark):
    frame = fact(spark)
    lookups = encode.fit_lookups(frame.filter("stock_sector <> 'Energy'").drop("transaction_id"))
    coded = encode.encode(frame, lookups, null_code=encode.UNSEEN)
    by_id = {r.transaction_id: r for r in coded.collect()}
    assert by_id["1"].stock_sector == -1  # Energy
    assert by_id["60"].stock_sector == -1 and by_id["60"].is_weekend == -1
    counts = coded.agg(*[n.alias(c) for c, n in encode.unseen_counts(coded).items()]).first()
    assert counts.stock_sector == 13
    kept = encode.decode(coded, lookups).filter("transaction_id = '1'").first()
    assert kept.stock_sector == "-1"


@pytest.mark.parametrize("n", [0, 1, 19, 20, 1000])
def test_split_sizes(spark, n):
    frame = spark.range(n).select(F.col("id").cast("string").alias("transaction_id"), F.lit(1).alias("x"))
    main, stream = split.split_for_streaming(frame)
    a = {r.transaction_id for r in main.collect()}
    b = {r.transaction_id for r in stream.collect()}
    assert len(a) == math.floor(n * 0.95) and len(b) == n - len(a)
    assert not a & b and len(a | b) == n


def test_cut_in_a_bucket_of_buckets(spark, monkeypatch):
    """Few digits and small buckets: the cut is found by several histograms."""
    frame = spark.range(3000).select(F.col("id").cast("string").alias("transaction_id"))
    pick = lambda: {r[0] for r in split.split_for_streaming(frame)[1].collect()}
    want = pick()
    monkeypatch.setattr(split, "DIGITS", 1)
    monkeypatch.setattr(split, "BUCKET_ROWS", 3)
    assert pick() == want and len(want) == 150


def test_a_column_without_lookup_is_unseen(spark):
    empty = fact(spark).withColumn("stock_sector", F.lit(None).cast("string")).drop("transaction_id")
    lookups = encode.fit_lookups(empty)
    coded = encode.encode(fact(spark), lookups).select("transaction_id", "stock_sector").collect()
    assert {r.stock_sector for r in coded if r.transaction_id != "60"} == {-1}
    assert [r.stock_sector for r in coded if r.transaction_id == "60"] == [None]


def test_written_split_is_the_same(spark, fresh):
    frame = spark.range(300).select(F.col("id").cast("string").alias("transaction_id"))
    rows = lambda f: {r[0] for r in f.collect()}
    lazy, written = split.split_for_streaming(frame), split.write_split(frame, fresh("split"))
    assert [rows(f) for f in lazy] == [rows(f) for f in written]


def test_split_is_reproducible_and_seeded(spark):
    frame = spark.range(500).select(F.col("id").cast("string").alias("transaction_id"))
    pick = lambda f, seed: {r[0] for r in split.split_for_streaming(f, seed=seed)[1].collect()}
    assert pick(frame, 42) == pick(frame.repartition(7), 42) != pick(frame, 43)
    with pytest.raises(ValueError):
        split.mark_stream(frame, share=1.5)


@pytest.mark.parametrize("sent", [8 << 20, 0])
def test_coding_with_sent_and_with_salted_lookups(spark, monkeypatch, sent):
    """A third of the rows NULL, a third one value, some unseen: both ways give the same."""
    monkeypatch.setattr(encode, "SENT_BYTES", sent)
    values = [None, "hot", *[f"v{i}" for i in range(40)]]
    rows = [(i, values[i % 3] if i % 3 < 2 else values[2 + i % 40], f"s{i % 5}") for i in range(600)]
    frame = spark.createDataFrame(rows, "transaction_id int, stock_ticker string, stock_sector string")
    lookups = encode.fit_lookups(frame.where("stock_ticker is null or stock_ticker != 'v7'").drop("transaction_id"))
    coded = encode.encode(frame, lookups, null_code=-1)
    known = sorted({r[1] for r in rows} - {None, "v7"})
    got = {r.transaction_id: (r.stock_ticker, r.stock_sector) for r in coded.collect()}
    assert got == {i: (known.index(t) if t in known else -1, int(s[1])) for i, t, s in rows}
    back = encode.decode(encode.encode(frame, lookups), lookups).collect()
    assert {r.transaction_id: r.stock_ticker for r in back} == {i: "-1" if t == "v7" else t for i, t, _ in rows}


def test_small_lookups_need_no_shuffle(spark):
    frame = spark.range(100).select(F.concat(F.lit("t"), F.col("id") % 7).alias("stock_ticker"), F.lit(None).cast("string").alias("stock_sector"))
    lookups = encode.fit_lookups(frame)
    plan = encode.encode(frame, lookups)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
