"""Null rules, fallbacks, filters, sources, and the catalogue against SQL."""

import datetime as dt
import glob
import math
import os
import random
import time
from collections import Counter

import duckdb
import pandas as pd
import pytest
from paths import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import check
from tradeloom.functions.columns import (
    exact_avg,
    exact_sum,
    exact_sum_sql,
    exact_totals,
    holiday_label,
    holiday_label_or_null,
    sum_of_totals,
    sum_or_zero,
)
from tradeloom.operators import filters, integrate
from tradeloom.plans import catalogue, questions, rollups, star, templates
from tradeloom.sources import files, jdbc, kafka, scratch, sinks


def tiny(spark):
    rows = [
        ("A", "BUY", False, 1, 10.0),
        ("A", "SELL", False, 2, None),
        (None, "BUY", False, 4, 5.0),
        ("B", "BUY", False, None, None),
    ]
    return spark.createDataFrame(
        rows,
        "stock_ticker string, transaction_type string, is_weekend boolean, quantity bigint, total_trade_amount double",
    ).withColumn("stock_sector", F.col("stock_ticker"))


def test_questions_keep_null_keys_rollups_drop_them(spark):
    kept = {r.stock_ticker: r.total_volume for r in questions.volume_by_ticker(tiny(spark)).collect()}
    assert kept == {"A": 3, None: 4, "B": None}
    rolled = {r.stock_ticker: tuple(r)[1:] for r in rollups.volume_by_ticker(tiny(spark)).collect()}
    assert rolled == {"A": (3, 10.0, 2), "B": (0, 0.0, 1)}


def test_null_keys_do_not_join(spark):
    prices = spark.createDataFrame([(dt.date(2024, 1, 1), None, 3.0)], "date date, stock_ticker string, stock_price double")
    trades = spark.createDataFrame([(dt.datetime(2024, 1, 1), None)], "timestamp timestamp_ntz, stock_ticker string")
    assert integrate.with_prices(trades, prices).first().stock_price is None


def test_fallback_branches(spark):
    none = questions.weekend_buy_sell_or_all(tiny(spark)).collect()
    assert [tuple(r) for r in none] == [("BUY", 3), ("SELL", 1)]
    one = tiny(spark).withColumn("is_weekend", F.col("transaction_type") == "SELL")
    assert [tuple(r) for r in questions.weekend_buy_sell_or_all(one).collect()] == [("SELL", 1)]
    sectors = questions.sql_weekend_sectors_or_all(tiny(spark)).collect()
    assert {r.stock_sector: r.total_volume for r in sectors} == {"A": 3, "B": None}
    weekend = tiny(spark).withColumn("is_weekend", F.col("stock_sector").isNull())
    assert [tuple(r) for r in questions.sql_weekend_sectors_or_all(weekend).collect()] == [(None, 4)]
    empty = tiny(spark).filter("false")
    assert questions.weekend_buy_sell_or_all(empty).collect() == []


def test_holiday_labels_of_unknown(spark):
    row = spark.range(1).select(F.lit(None).cast("boolean").alias("f")).select(
        holiday_label("f").alias("a"), holiday_label_or_null("f").alias("b")
    ).first()
    assert tuple(row) == ("Non-Holiday", None)


def sums(frame):
    """The sum of column x by both forms, for several partitionings."""
    measures = [exact_sum("x").alias("a"), F.expr(exact_sum_sql("x")).alias("b"), exact_avg("x").alias("c")]
    rows = {tuple(frame.repartition(n).agg(*measures).first()) for n in (1, 3, 11)}
    assert len(rows) == 1
    (row,) = rows
    assert row[0] == row[1] or (row[0] != row[0] and row[1] != row[1])
    return row[0]


@pytest.mark.parametrize("scale", [(-9, 14), (-12, -10), (0, 0), (-5, 5)])
def test_sums_are_exact_and_independent_of_partitions(spark, scale):
    rng = random.Random(str(scale))
    xs = [rng.uniform(-1, 1) * 10 ** rng.randint(*scale) for _ in range(2000)] + [None]
    assert sums(spark.createDataFrame([(x,) for x in xs], "x double")) == math.fsum(xs[:-1])


def test_sums_of_tiny_values_are_rounded_like_any_double_sum(spark):
    """What is below 2**-68 goes through one double sum."""
    rng = random.Random(30)
    xs = [rng.uniform(-1, 1) * 10 ** rng.randint(-30, -20) for _ in range(2000)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").agg(exact_sum("x")).first()[0]
    assert got == pytest.approx(math.fsum(xs), rel=1e-12)


@pytest.mark.parametrize(
    "xs",
    [
        [0.1, 0.2, -0.3, 1e10, -1e10], [1e-5, 1e15, -1e15], [1e18, 1.5, -1e18, -1.5, 1e-17], [-1e-17, -2.5e-9], [-(2.0**-60)],
        [2.0**70, 1.0, -(2.0**70)], [1e300, 1e-300], [5e-324, 5e-324], [0.1] * 30 + [123456789.0123, -5.5, 89999999999.99],
        [9.3e18, -9.2e18, 3.0], [-0.1, -0.2, -0.3], [0.0, -0.0],
    ],
)
def test_sums_of_any_doubles(spark, xs):
    assert sums(spark.createDataFrame([(x,) for x in xs], "x double")) == math.fsum(xs)


@pytest.mark.parametrize("xs", [[math.nan, 1.0], [math.inf, 1.0], [-math.inf, 3.0], [math.inf, -math.inf], [math.inf, math.nan]])
def test_sums_of_what_is_not_finite(spark, xs):
    want = xs[0] + xs[1]
    frame = spark.createDataFrame([(x,) for x in xs], "x double")
    for measure in (exact_sum("x"), F.expr(exact_sum_sql("x")), sum_or_zero("x")):
        got = frame.agg(measure).first()[0]
        assert got == want or (math.isnan(got) and math.isnan(want))


def test_sums_without_values(spark):
    frame = spark.createDataFrame([(None,), (None,)], "x double")
    for rows in (frame, frame.filter("false")):
        assert tuple(rows.agg(exact_sum("x"), exact_avg("x"), sum_or_zero("x")).first()) == (None, None, 0.0)
    wide = spark.createDataFrame([(1, 2), (1, None), (2, None)], "k int, x bigint")
    assert {r.k: (r.s, r.m) for r in wide.groupBy("k").agg(exact_sum("x").alias("s"), exact_avg("x").alias("m")).collect()} == {
        1: (2.0, 2.0), 2: (None, None)
    }


def shipped(name):
    """A sample output of the project whose queries these are, where it is at hand."""
    path = next(iter(glob.glob(f"/root/*/app/output/{name}")), None)
    return path or pytest.skip("the sample outputs are not here")


def test_sample_trades_aggregate_as_they_are(spark):
    path = shipped("sample_output.csv")
    table = pd.read_csv(path, float_precision="round_trip")
    fact = spark.read.csv(path, header=True, inferSchema=True)
    got = {r.stock_sector: r for r in fact.groupBy("stock_sector").agg(
        exact_sum("total_trade_amount").alias("s"), exact_avg("stock_price").alias("m")).collect()}
    assert len(got) == table.stock_sector.nunique()
    for sector, rows in table.groupby("stock_sector"):
        assert got[sector].s == math.fsum(rows.total_trade_amount)
        assert got[sector].m == math.fsum(rows.stock_price) / len(rows)
    days = {r.day_name: r.total_trade_amount for r in questions.amount_by_day(fact).collect()}
    assert days == {d: math.fsum(rows.total_trade_amount) for d, rows in table.groupby("day_name")}


def test_sample_statistics_aggregate_as_they_are(spark):
    for name, columns in {
        "streaming_attributes/stock_statistics.csv": ["stock_price_mean", "stock_price_std", "total_trade_amount_median"],
        "streaming_attributes/avg_stock_prices_monthly.csv": ["avg_price"],
    }.items():
        path = shipped(name)
        table, frame = pd.read_csv(path, float_precision="round_trip"), spark.read.csv(path, header=True, inferSchema=True)
        for column in columns:
            row = frame.agg(exact_sum(column).alias("s"), exact_avg(column).alias("m")).first()
            known = table[column].dropna()
            assert tuple(row) == (math.fsum(known), math.fsum(known) / len(known))


def test_minmax_needs_three_sectors_and_accepts_equal_ones(spark):
    rows = [(s, 2.0, 1, 5.0) for s in "abc"]
    schema = "stock_sector string, stock_price double, quantity bigint, total_trade_amount double"
    same = rollups.sector_minmax(spark.createDataFrame(rows, schema)).collect()
    assert [tuple(r)[1:] for r in same] == [(0.0, 0.0, 0.0, 0.0)] * 3
    assert rollups.sector_minmax(spark.createDataFrame(rows[:2], schema)).collect() == []


def test_histogram_of_equal_totals(spark):
    frame = spark.createDataFrame([(1, 5.0), (2, 5.0)], "customer_id bigint, total_trade_amount double")
    got = [r.customers for r in rollups.customer_histogram(frame).orderBy("bin").collect()]
    assert got == [2] + [0] * 49


def test_tree_totals(spark):
    fact = star.fact(spark, SMALL, *rollups.tier_sector_tree.reads)
    rows = rollups.tier_sector_tree(fact).collect()
    total = [r.total_amount for r in rows if r.level == 3]
    assert len(total) == 1
    for level in (0, 1):
        assert sum(r.total_amount for r in rows if r.level == level) == pytest.approx(total[0], rel=1e-12)


def test_all_means_no_filter(spark):
    fact = star.fact(spark, SMALL, "transaction_id", "stock_sector")
    assert filters.choose(fact, sectors=["All"]).count() == filters.choose(fact).count() == 6000
    assert filters.choose(fact, sectors=["PROMO"]).count() < 6000


# --- plans ---------------------------------------------------------------------


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_day_filter_reaches_the_scan(spark):
    orders = star.read(spark, SMALL, "orders").select(F.col("o_orderdate").alias("timestamp"), "o_custkey")
    plan = plan_of(filters.choose(orders, days=("1997-01-01", "1997-12-31")))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    assert "o_totalprice" not in plan


def test_only_needed_columns_and_joins(spark):
    plan = plan_of(catalogue.queries()["q1_volume_by_ticker"](spark, SMALL))
    assert "Join" not in plan and "l_extendedprice" not in plan


@pytest.mark.parametrize("name", ["jn_price", "an_sector", "agg_sunburst", "agg_customer_distribution", "flt_all"])
def test_no_cross_joins(spark, name):
    plan = plan_of(catalogue.queries()[name](spark, SMALL))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_sums_of_groups_join_exactly(spark):
    """Totals of groups give the sum of all rows, not the sum of rounded sums."""
    xs = [1e16, 1.0, -1e16, 1.0, 0.1, 1e-9, None] * 3 + [2.0**60, 0.5, -(2.0**60)]
    rows = spark.createDataFrame([(i % 4, x) for i, x in enumerate(xs)] + [(9, None)], "k int, x double")
    parts = rows.groupBy("k").agg(exact_totals("x").alias("t"))
    assert parts.agg(sum_of_totals("t")).first()[0] == math.fsum(x for x in xs if x is not None)
    assert parts.filter("k = 9").agg(sum_of_totals("t")).first()[0] is None


def test_customers_are_hashed_and_their_first_type_is_kept(spark, monkeypatch):
    """Several types, types without ids, unknown types, amounts and customers; no trade is sorted."""
    rng = random.Random(5)
    trades = [
        (c, rng.choice([1e16, -1e16, 0.1, 2.5, None]), rng.choice([None, "A", "B", "C"] if c % 2 else [None, "A"]), f"{i:04}")
        for i, c in enumerate(rng.choices(range(1, 40), k=600))
    ]
    trades += [(50, 1.0, "A", None), (50, 1.0, "B", "0700"), (51, 1.0, "A", None), (52, None, None, "0701"), (None, 1.0, "A", "0702")]
    rng.shuffle(trades)
    schema = "customer_id bigint, total_trade_amount double, customer_account_type string, transaction_id string"
    plans = []
    written = rollups.materialize
    monkeypatch.setattr(rollups, "materialize", lambda frame, label: plans.append(plan_of(frame)) or written(frame, label))
    got = [tuple(r) for r in rollups.customer_distribution(spark.createDataFrame(trades, schema)).collect()]

    wanted = []
    for c in {t[0] for t in trades} - {None}:
        own = [t for t in trades if t[0] == c]
        firsts = sorted((t[3], t[2]) for t in own if t[3] is not None and t[2] is not None)
        total = math.fsum(t[1] for t in own if t[1] is not None)
        wanted.append((c, total, len(own), firsts[0][1] if firsts else None))
    assert got == sorted(wanted, key=lambda r: (-r[1], r[0]))
    per_type = [line for line in plans[0].splitlines() if "Aggregate" in line and "_type" in line.partition("functions=")[0]]
    assert len(per_type) >= 2 and all("HashAggregate" in line for line in per_type), plans[0]


# --- sources and sinks ---------------------------------------------------------


def test_csv_suffix(spark):
    with pytest.raises(ValueError):
        files.read_csv(spark, "/data/trades.xlsx", "a int")


def test_first_available(spark, fresh):
    path = fresh("there")
    spark.range(3).write.parquet(path)
    frame = files.first_available([lambda: spark.read.parquet(fresh("gone")), lambda: spark.read.parquet(path)])
    assert frame.count() == 3
    with pytest.raises(FileNotFoundError):
        files.first_available([lambda: spark.table("no_such_table_here")])


def test_save_formats(spark, fresh):
    with pytest.raises(ValueError):
        sinks.save(spark.range(1), fresh(), "xml")
    path = fresh("empty")
    sinks.save_result(spark.range(1).filter("id < 0"), path)
    assert spark.read.option("header", True).csv(path).columns == ["id"]


def test_table_info_of_missing_table(spark):
    with pytest.raises(ValueError):
        files.table_info(spark, "no_such_table_here")


def test_append_fills_missing_columns(spark):
    old = spark.range(1).select("id")
    new = old.withColumn("x", F.lit(1))
    assert sorted(map(tuple, sinks.append(old, new).collect()), key=str) == [(0, 1), (0, None)]
    assert sinks.append(None, new).columns == ["id", "x"]


def test_user_sql_keeps_all_rows(spark):
    spark.range(5000).createOrReplaceTempView("many")
    assert templates.run_sql(spark, "select * from many").count() == 5000
    assert templates.preview_sql(spark, "select * from many", 7).count() == 7


def test_scratch_folder_is_demanded_and_shared(spark):
    assert scratch.checked_folder("file:/x/", "local[4]") == "file:/x"
    assert scratch.checked_folder("s3a://b/x", "spark://m:7077") == "s3a://b/x"
    for folder, default in (("file:/x", "hdfs://n/"), ("/x", "file:///")):
        with pytest.raises(RuntimeError, match="do not share"):
            scratch.checked_folder(folder, "spark://m:7077", default)

    class Unset:
        conf = {}

    with pytest.raises(RuntimeError, match="set spark.checkpoint.dir"):
        scratch.shared_folder(Unset)


class ElsewhereSession:
    """A session whose settings name a cluster's master; its tasks run here."""

    def __init__(self, spark, read=None, **settings):
        self.conf = {"spark.master": "spark://m:7077", "spark.app.id": "x", **settings}
        self.sparkContext, self.range, self.read = spark.sparkContext, spark.range, read or spark.read


def test_a_path_that_all_tasks_reach_serves_a_cluster(spark, tmp_path):
    folder = f"{tmp_path}/mounted"
    for name in (folder, f"file://{folder}/"):
        session = ElsewhereSession(spark, **{"spark.checkpoint.dir": name})
        assert scratch.shared_folder(session) == name.rstrip("/")
        assert scratch.fresh_path(session, "prices").startswith(f"{name.rstrip('/')}/tradeloom/x/prices-")


def test_a_path_whose_rows_are_not_found_again_is_refused(spark, tmp_path):
    class OneMachineLess:
        def schema(self, _):
            return self

        def parquet(self, _):
            return spark.range(1)

    session = ElsewhereSession(spark, OneMachineLess(), **{"spark.checkpoint.dir": f"{tmp_path}/own"})
    for _ in range(2):
        with pytest.raises(RuntimeError, match="do not share"):
            scratch.shared_folder(session)


def test_scratch_goes_below_the_warehouse_where_nothing_else_is_named(spark):
    class Plain:
        conf = {"spark.master": "local[2]", "spark.sql.warehouse.dir": "file:/w/"}

    assert scratch.shared_folder(Plain) == "file:/w"

    class WithContext(Plain):
        class sparkContext:
            getCheckpointDir = staticmethod(lambda: "s3a://b/kept")

    assert scratch.shared_folder(WithContext) == "s3a://b/kept"


def test_scratch_tables_are_released(spark):
    table = scratch.materialize(spark.range(3), "gone")
    assert table.count() == 3
    scratch.release(spark)
    with pytest.raises(Exception):
        spark.read.parquet(scratch.fresh_path(spark, "x").rpartition("/")[0]).count()


def test_new_values_are_not_lost(spark, tmp_path):
    """A further brand, sector, day and a key of 13 digits, through panel, heat map and calendar."""
    day = lambda *d: dt.datetime(*d)
    tables = {
        "lineitem": ([(1, 1234567890123, 1, 1, 2.0, 20.0, 0.0, 0.0, "N", "O", day(2031, 2, 2)),
                      (2, 1234567890129, 1, 1, 2.0, 30.0, 0.0, 0.0, "N", "O", day(2031, 2, 2))],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "orders": ([(1, 1, "O", 9.0, day(2031, 2, 1), "p"), (2, 1, "O", 9.0, day(1970, 7, 4), "p")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "part": ([(1234567890123, "n", "Brand#99", "NEWSECTOR", 1, 1.0), (1234567890129, "n", "Brand#1", "SMALL", 1, 1.0)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "customer": ([(1, "c", 1, 0.0, "BUILDING")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    sf = str(tmp_path)
    all_queries = entry_point.queries()
    assert {c for c in all_queries["fn_pivot"](spark, sf).columns} == {"date", "Brand_1", "Brand_99"}
    heat = {r.day_name: r for r in all_queries["agg_heatmap"](spark, sf).collect()}
    assert sum(r.NEWSECTOR for r in heat.values()) == 1 == sum(r.SMALL for r in heat.values())
    fact = star.fact(spark, sf, "stock_ticker", "day_name", "is_weekend", "is_holiday").collect()
    assert {r.stock_ticker for r in fact} == {"STK1234567890123", "STK1234567890129"}
    assert {(r.day_name, r.is_weekend, r.is_holiday) for r in fact} == {("Saturday", True, False), ("Saturday", True, True)}
    with pytest.raises(ValueError, match="more than 1 values"):
        star.few_values(star.read(spark, sf, "part"), "p_brand", most=1)


def test_jdbc_options():
    w = jdbc.Warehouse("jdbc:postgresql://db/trades", "reader", "secret")
    assert w.read_options(table="t")["dbtable"] == "t" and w.read_options(query="select 1")["query"] == "select 1"
    assert w.read_options(table="t", split=("id", 0, 10, 4))["numPartitions"] == "4"
    assert w.options()["batchsize"] == "1000" and "secret" not in repr(w)
    for wrong in ({}, {"table": "t", "query": "q"}):
        with pytest.raises(ValueError):
            w.read_options(**wrong)
    assert [jdbc.write_mode(m) for m in ("replace", "append", "fail")] == ["overwrite", "append", "error"]
    with pytest.raises(ValueError):
        jdbc.write_mode("upsert")
    with pytest.raises(RuntimeError):
        jdbc.check_written(3, 2, "t")


def test_jdbc_counts_while_it_writes(spark, monkeypatch):
    """The plan runs once; the rows found afterwards must match the rows written."""
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    kept = {}
    monkeypatch.setattr(jdbc, "save", lambda frame, options, mode: kept.update(n=len(frame.collect())))
    monkeypatch.setattr(jdbc, "read", lambda spark, warehouse, **what: spark.range(kept["n"]))
    frame = spark.range(7).mapInArrow(count, "id long")
    jdbc.write(frame, jdbc.Warehouse("jdbc:x", "u", "p"), "t")
    assert runs.value == 7
    monkeypatch.setattr(jdbc, "read", lambda spark, warehouse, **what: spark.range(6))
    with pytest.raises(RuntimeError, match="wrote 7 rows but found 6"):
        jdbc.write(frame, jdbc.Warehouse("jdbc:x", "u", "p"), "t")


def test_kafka_options():
    source = kafka.source_options("broker:9092", "trades", max_offsets=100)
    assert source["startingOffsets"] == "earliest" and source["maxOffsetsPerTrigger"] == "100"
    assert kafka.sink_options("broker:9092", "trades")["topic"] == "trades"


# --- the catalogue against SQL -------------------------------------------------

CHECKED = [
    "jn_integrate",
    "jn_encode",
    "jn_decode",
    "q2b_avg_price_onehot",
    "sql_q5c_liquidity_pivot_full",
    "an_customer_type",
    "agg_holiday_stats",
    "agg_volume_top_bottom5",
    "agg_stock_stats",
    "agg_heatmap",
    "tpl_sector_liquidity",
    "win_interpolate",
    "win_portfolio_map",
    "win_price_candidates",
    "set_split",
    "dq_profile",
    "tf_outlier_interpolate",
    "st_encode",
    "st_monitor",
]


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for table in check.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, sql, name):
    verdict, _ = check.compare(spark, sql, name, SMALL)
    assert verdict.startswith("ok"), verdict


def _tables(spark):
    return {os.path.basename(p).rpartition("-")[0] + "@" + p for p in glob.glob(f"{scratch._own_folder(spark)}/*")}


def test_scratch_leaves_no_shuffles_and_no_spent_tables(spark):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    known = shuffles()
    first = scratch.materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "first")
    assert [p for p in first.inputFiles() if "/first-" in p]
    for _ in range(100):  # removed in the background
        if not shuffles() - known:
            break
        time.sleep(0.1)
    assert not shuffles() - known
    before = _tables(spark)
    second = scratch.materialize(first.where("k > 2"), "second", "zstd", spent=first)
    assert second.count() == 4 and all(p.endswith(".zstd.parquet") for p in second.inputFiles())
    assert {t.partition("@")[0] for t in before - _tables(spark)} == {"first"}


def test_decode_keeps_the_coded_rows_only(spark):
    before = _tables(spark)
    assert catalogue.tf_decode(spark, SMALL).count() == star.fact(spark, SMALL).count()
    assert sorted(t.partition("@")[0] for t in _tables(spark) - before) == ["coded", "lookups", "slices"]


def test_portfolio_map_keeps_the_positions_only(spark):
    before = _tables(spark)
    assert catalogue.win_portfolio_map(spark, SMALL).count() == star.fact(spark, SMALL).count()
    assert sorted(t.partition("@")[0] for t in _tables(spark) - before) == ["positions"]


def test_inference_pipeline_drops_what_it_has_valued(spark):
    before = _tables(spark)
    assert catalogue.queries()["pipe_m1"](spark, SMALL).count() == star.fact(spark, SMALL).count()
    left = [t.partition("@")[0] for t in _tables(spark) - before]
    assert "positions" not in left and left.count("held") == 1 and left.count("slices") <= 1  # those of the quartiles


def test_profile_covers_the_fact(spark):
    """Every column of the fact, with the ids of the trades and the values they compute."""
    got = {r.column_name: r for r in catalogue.dq_profile(spark, SMALL).collect()}
    assert list(got) and set(got) == set(catalogue.schemas.FACT_COLUMNS)
    fact = star.fact(spark, SMALL, "transaction_id", "stock_price").collect()
    ids = Counter(r.transaction_id for r in fact)
    assert got["transaction_id"].unique_values == len(ids)
    assert got["transaction_id"].common_values == "|".join(sorted(ids, key=lambda i: (-ids[i], i))[:5])
    assert got["stock_price"].max_value == max(r.stock_price for r in fact)


def test_contract(spark):
    assert entry_point.oracle_sql().keys() <= entry_point.queries().keys()
    assert entry_point.entry(spark).columns == list(catalogue.schemas.FACT_COLUMNS)
