"""Serving roll-ups and dashboard aggregates.

Unlike the questions, these drop rows whose group key is unknown and report 0
for a group whose measure is unknown throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import (
    count_or_zero,
    exact_avg,
    exact_sum,
    exact_totals,
    holiday_label_or_null,
    sum_of_totals,
    sum_or_zero,
    weekday_position,
    year_month,
)
from tradeloom.operators.quantiles import exact_quantiles
from tradeloom.plans.reads import reads
from tradeloom.sources.scratch import materialize

MEASURES = ("quantity", "total_trade_amount")


def _by(frame: DataFrame, *keys: str, **measures: Column) -> DataFrame:
    """Group by known keys."""
    return (
        frame.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(*[column.alias(name) for name, column in measures.items()])
    )


def _activity(frame: DataFrame, *keys: str, volume: str = "total_volume") -> DataFrame:
    return _by(
        frame,
        *keys,
        **{
            volume: count_or_zero("quantity"),
            "total_amount": sum_or_zero("total_trade_amount"),
            "transaction_count": F.count("*"),
        },
    )


# --- serving roll-ups ----------------------------------------------------------


@reads("stock_ticker", *MEASURES)
def volume_by_ticker(fact: DataFrame) -> DataFrame:
    return _activity(fact, "stock_ticker")


@reads("stock_sector", "timestamp", "stock_price", "total_trade_amount")
def price_by_sector(fact: DataFrame) -> DataFrame:
    return _by(
        fact,
        "stock_sector",
        "timestamp",
        stock_price=exact_avg("stock_price"),
        total_trade_amount=sum_or_zero("total_trade_amount"),
    )


@reads("transaction_type", *MEASURES)
def buy_vs_sell(fact: DataFrame) -> DataFrame:
    return _activity(fact, "transaction_type", volume="total_quantity")


@reads("day_name", *MEASURES)
def trading_by_day(fact: DataFrame) -> DataFrame:
    return _activity(fact, "day_name")


@reads("day_name", *MEASURES)
def trading_by_day_ordered(fact: DataFrame) -> DataFrame:
    """Monday to Sunday, with the position that orders them."""
    days = _activity(fact, "day_name").withColumn("day_position", weekday_position("day_name"))
    return days.orderBy("day_position")


@reads("customer_id", "total_trade_amount", "customer_account_type", "transaction_id")
def customer_distribution(fact: DataFrame) -> DataFrame:
    """Totals per customer with the account type on their first trade.

    A customer's trades are counted per account type, in buffers of a fixed size that are hashed:
    nothing is sorted by customer before the totals are. Ids are compared only among the trades
    of customers with several types.
    """
    # A trade without an id is nobody's first one.
    kinds = fact.withColumn("_type", F.when(F.col("transaction_id").isNotNull(), F.col("customer_account_type")))
    per_type = (
        kinds.dropna(subset=["customer_id"])
        .groupBy("customer_id", "_type")
        .agg(exact_totals("total_trade_amount").alias("_amount"), F.count("*").alias("_trades"))
    )
    per_customer = materialize(
        per_type.groupBy("customer_id").agg(
            F.coalesce(sum_of_totals("_amount"), F.lit(0.0)).alias("total_amount"),
            F.sum("_trades").alias("transaction_count"),
            F.min("_type").alias("account_type"),
            F.count("_type").alias("_types"),
        ),
        "per-customer",
    )
    several = per_customer.filter("_types > 1").select("customer_id")
    if not several.isEmpty():
        firsts = (
            kinds.join(several, "customer_id", "left_semi")
            .groupBy("customer_id")
            .agg(F.min_by("_type", F.when(F.col("_type").isNotNull(), F.col("transaction_id"))).alias("_first"))
        )
        per_customer = per_customer.join(firsts, "customer_id", "left").withColumn(
            "account_type", F.coalesce("_first", "account_type")
        )
    out = per_customer.select("customer_id", "total_amount", "transaction_count", "account_type")
    return out.orderBy(F.desc("total_amount"), "customer_id")


@reads("customer_id", "total_trade_amount", "customer_account_type", "transaction_id")
def top_customers(fact: DataFrame, n: int = 10) -> DataFrame:
    return customer_distribution(fact).limit(n)


@reads("is_holiday", *MEASURES)
def holiday_comparison(fact: DataFrame) -> DataFrame:
    per_flag = _by(
        fact,
        "is_holiday",
        total_quantity=count_or_zero("quantity"),
        total_amount=sum_or_zero("total_trade_amount"),
        transaction_count=F.count("*"),
    )
    return per_flag.withColumn("is_holiday", holiday_label_or_null("is_holiday"))


@reads("is_holiday", *MEASURES)
def holiday_stats(fact: DataFrame) -> DataFrame:
    """Per status: counts, sums and mean, and how far the two means lie apart in percent.

    The percentage is measured against the ordinary days and is the same on both
    rows; it is NULL if one of the two has no trades.
    """
    stats = _by(
        fact.select(holiday_label_or_null("is_holiday").alias("status"), *MEASURES),
        "status",
        transaction_count=F.count("*"),
        total_volume=count_or_zero("quantity"),
        total_amount=sum_or_zero("total_trade_amount"),
        avg_amount=exact_avg("total_trade_amount"),
    )
    mean = lambda status: F.max(F.when(F.col("status") == status, F.col("avg_amount")))
    means = stats.agg(F.struct(mean("Holiday").alias("h"), mean("Non-Holiday").alias("n"))).scalar()
    m = F.col("_means")
    apart = F.try_divide(m["h"] - m["n"], m["n"]) * 100
    return (
        stats.withColumn("_means", means)
        .withColumn("difference_percent", F.round(apart, 6))
        .drop("_means")
    )


@reads("stock_sector", *MEASURES)
def sector_comparison(fact: DataFrame) -> DataFrame:
    return _by(
        fact,
        "stock_sector",
        total_amount=sum_or_zero("total_trade_amount"),
        avg_amount=exact_avg("total_trade_amount"),
        total_volume=count_or_zero("quantity"),
        transaction_count=F.count("*"),
    )


@reads("stock_sector", "stock_price", *MEASURES)
def sector_metrics(fact: DataFrame) -> DataFrame:
    return _by(
        fact,
        "stock_sector",
        transactions=F.count("*"),
        volume=count_or_zero("quantity"),
        total_amount=sum_or_zero("total_trade_amount"),
        avg_price=exact_avg("stock_price"),
    ).withColumnRenamed("stock_sector", "sector")


@reads("stock_sector", "stock_price", *MEASURES)
def sector_minmax(fact: DataFrame) -> DataFrame:
    """The sector metrics scaled to [0, 1]; empty with fewer than three sectors."""
    metrics = sector_metrics(fact)
    names = ["transactions", "volume", "total_amount", "avg_price"]
    span = metrics.agg(
        F.struct(
            F.count("*").alias("n"),
            *[F.min(c).cast("double").alias(f"{c}_low") for c in names],
            *[F.max(c).cast("double").alias(f"{c}_high") for c in names],
        )
    ).scalar()
    s = F.col("_span")
    scaled = []
    for c in names:
        low, width = s[f"{c}_low"], s[f"{c}_high"] - s[f"{c}_low"]
        value = F.when(width == 0, 0.0).otherwise(F.try_divide(F.col(c) - low, width))
        scaled.append(F.round(value, 6).alias(c))
    return metrics.withColumn("_span", span).filter(s["n"] >= 3).select("sector", *scaled)


@reads("stock_liquidity_tier", "timestamp", *MEASURES)
def liquidity_daily(fact: DataFrame) -> DataFrame:
    return _by(
        fact,
        "stock_liquidity_tier",
        "timestamp",
        total_trade_amount=sum_or_zero("total_trade_amount"),
        quantity=count_or_zero("quantity"),
    )


@reads("stock_liquidity_tier", *MEASURES)
def liquidity_distribution(fact: DataFrame) -> DataFrame:
    return _activity(fact, "stock_liquidity_tier").withColumnRenamed("stock_liquidity_tier", "liquidity_tier")


def _tree(fact: DataFrame, parent: str, child: str) -> DataFrame:
    """Totals of the leaves, of the parents and of everything.

    The fact is reduced to leaves first; the rollup then expands only those.
    """
    leaves = (
        fact.dropna(subset=[parent, child])
        .groupBy(parent, child)
        .agg(exact_sum("total_trade_amount").alias("amount"))
    )
    return (
        leaves.rollup(parent, child)
        .agg(
            sum_or_zero("amount").alias("total_amount"),
            F.grouping_id().cast("bigint").alias("level"),
        )
        .select(parent, child, "level", "total_amount")
    )


@reads("stock_liquidity_tier", "stock_sector", "total_trade_amount")
def tier_sector_tree(fact: DataFrame) -> DataFrame:
    """level 0 = leaf, 1 = tier, 3 = grand total."""
    return _tree(fact, "stock_liquidity_tier", "stock_sector")


@reads("stock_sector", "stock_industry", "total_trade_amount")
def sector_industry_tree(fact: DataFrame) -> DataFrame:
    """level 0 = leaf, 1 = sector, 3 = grand total."""
    return _tree(fact, "stock_sector", "stock_industry")


@reads("timestamp", "stock_ticker", "customer_id", *MEASURES)
def summary(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("*").alias("total_transactions"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
        F.count_distinct("stock_ticker").alias("unique_stocks"),
        F.count_distinct("customer_id").alias("unique_customers"),
        count_or_zero("quantity").alias("total_volume"),
        sum_or_zero("total_trade_amount").alias("total_trade_amount"),
    )


# --- dashboard -----------------------------------------------------------------


@reads("stock_ticker", "customer_id", "stock_price", "total_trade_amount")
def kpis(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("*").alias("total_transactions"),
        sum_or_zero("total_trade_amount").alias("total_trade_volume"),
        F.count_distinct("stock_ticker").alias("unique_stocks"),
        F.count_distinct("customer_id").alias("active_customers"),
        exact_avg("stock_price").alias("avg_stock_price"),
    )


@reads("stock_ticker", "quantity")
def volume_top_bottom(fact: DataFrame, n: int = 5) -> DataFrame:
    """The n busiest and the n quietest tickers; both ends are cut by a top-n sort."""
    volume = _by(fact, "stock_ticker", quantity=count_or_zero("quantity"))
    top = volume.orderBy(F.desc("quantity"), "stock_ticker").limit(n)
    bottom = volume.orderBy("quantity", F.desc("stock_ticker")).limit(n)
    return top.withColumn("side", F.lit("top")).unionByName(bottom.withColumn("side", F.lit("bottom")))


@reads("timestamp", "stock_sector", "stock_price")
def price_trend(fact: DataFrame) -> DataFrame:
    days = fact.withColumn("date", F.to_date("timestamp"))
    return _by(days, "date", "stock_sector", avg_price=exact_avg("stock_price"))


@reads("stock_sector", "stock_price")
def sector_price_stats(fact: DataFrame) -> DataFrame:
    return _by(
        fact,
        "stock_sector",
        avg_price=exact_avg("stock_price"),
        min_price=F.min("stock_price"),
        max_price=F.max("stock_price"),
        std_price=F.stddev_samp("stock_price"),
    )


@reads("transaction_type", "total_trade_amount")
def type_counts(fact: DataFrame) -> DataFrame:
    counts = _by(
        fact,
        "transaction_type",
        transaction_count=F.count("*"),
        total_trade_amount=sum_or_zero("total_trade_amount"),
    )
    return counts.orderBy(F.desc("transaction_count"), "transaction_type")


@reads("customer_id", "total_trade_amount")
def customer_histogram(fact: DataFrame, bins: int = 50) -> DataFrame:
    """Customers per equal-width bin of their total amount; empty bins show 0."""
    totals = _by(fact, "customer_id", total=sum_or_zero("total_trade_amount"))
    ends = totals.agg(F.struct(F.min("total").alias("low"), F.max("total").alias("high"))).scalar()
    e = F.col("_ends")
    low, width = e["low"], (e["high"] - e["low"]) / bins
    position = F.coalesce(F.floor(F.try_divide(F.col("total") - low, width)), F.lit(0))
    counted = totals.withColumn("_ends", ends).groupBy(F.least(position, F.lit(bins - 1)).alias("bin")).agg(
        F.count("*").alias("customers")
    )
    every_bin = fact.sparkSession.range(0, bins, numPartitions=1).select(
        F.col("id").alias("bin"), ends.alias("_ends")
    )
    return every_bin.join(counted, "bin", "left").select(
        "bin",
        F.round(low + width * F.col("bin"), 4).alias("lower"),
        F.round(low + width * (F.col("bin") + 1), 4).alias("upper"),
        F.coalesce("customers", F.lit(0)).alias("customers"),
    )


RECENT_COLUMNS = ["timestamp", "stock_ticker", "transaction_type", "quantity", "stock_price", "total_trade_amount"]


def _latest(fact: DataFrame, n: int) -> DataFrame:
    return fact.orderBy(F.desc("timestamp"), F.desc("transaction_id")).limit(n)


@reads("timestamp", "transaction_id")
def recent_hourly(fact: DataFrame, last: int = 100) -> DataFrame:
    recent = _latest(fact, last)
    return recent.groupBy(F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("hour")).agg(
        F.count("*").alias("trades")
    )


@reads("transaction_id", *RECENT_COLUMNS)
def recent_rows(fact: DataFrame, last: int = 20) -> DataFrame:
    return _latest(fact, last).select(*RECENT_COLUMNS)


@reads("timestamp", "stock_ticker", "stock_price")
def monthly_price(fact: DataFrame) -> DataFrame:
    months = fact.withColumn("year_month", year_month("timestamp"))
    return _by(months, "year_month", "stock_ticker", avg_price=exact_avg("stock_price"))


@reads("stock_ticker", "stock_price", *MEASURES)
def stock_stats(fact: DataFrame) -> DataFrame:
    """Mean, exact median and deviation per ticker. Medians are ranked across tasks."""
    known = fact.dropna(subset=["stock_ticker"])
    measured = ["stock_price", "quantity", "total_trade_amount"]
    moments = {
        "stock_price_mean": exact_avg("stock_price"),
        "stock_price_std": F.stddev_samp("stock_price"),
        "quantity_mean": exact_avg("quantity"),
        "total_trade_amount_mean": exact_avg("total_trade_amount"),
    }
    halves = exact_quantiles(known, ["stock_ticker"], measured, {"median": 0.5})
    medians = halves.groupBy("stock_ticker").agg(
        *[F.max(F.when(F.col("column_name") == c, F.col("median"))).alias(f"{c}_median") for c in measured]
    )
    shown = ["stock_ticker", *[f"{c}_{m}" for c in measured for m in ("mean", "median")], "stock_price_std"]
    return _by(known, "stock_ticker", **moments).join(medians, "stock_ticker", "left").select(*shown)


def query_log_metrics(log: DataFrame) -> DataFrame:
    """Totals over the query log in one pass; the running mean is the mean."""
    return log.agg(
        F.count("*").alias("total_queries"),
        F.count_if(F.col("status") == "success").alias("successful_queries"),
        F.count_if(F.col("status") != "success").alias("failed_queries"),
        F.avg("execution_time_ms").alias("avg_execution_time"),
        F.max("timestamp").alias("last_updated"),
    )


# --- announced by the dashboard's document -------------------------------------


@reads("is_weekend", *MEASURES)
def weekend_weekday(fact: DataFrame) -> DataFrame:
    return _activity(fact, "is_weekend")


@reads("quantity")
def average_trade_size(fact: DataFrame) -> DataFrame:
    return fact.agg(exact_avg("quantity").alias("avg_trade_size"))


@reads("customer_id", "quantity")
def top_customers_by_volume(fact: DataFrame, n: int = 10) -> DataFrame:
    volume = _by(fact, "customer_id", total_volume=count_or_zero("quantity"))
    return volume.orderBy(F.desc("total_volume"), "customer_id").limit(n)


@reads("day_name", "stock_sector")
def day_sector_heatmap(fact: DataFrame, sectors: Sequence[str]) -> DataFrame:
    """Trades per weekday and sector as a matrix, one column per sector."""
    cells = _by(fact, "day_name", "stock_sector", trades=F.count("*"))
    matrix = cells.groupBy("day_name").pivot("stock_sector", list(sectors)).agg(F.sum("trades"))
    return matrix.na.fill(0)
