"""The DataFrame and SQL questions over the decoded fact.

Null keys keep their own group here, as in any Spark aggregation. Each sort ends
in the group key, so equal measures come in a fixed order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import day_name, exact_avg, exact_avg_sql, exact_sum, exact_sum_sql
from tradeloom.plans.reads import reads


def _ranked(frame: DataFrame, measure: str, *keys: str) -> DataFrame:
    return frame.orderBy(F.desc(measure), *keys)


# --- DataFrame questions -------------------------------------------------------


@reads("stock_ticker", "quantity")
def volume_by_ticker(stocks: DataFrame) -> DataFrame:
    per_ticker = stocks.groupBy("stock_ticker").agg(F.sum("quantity").alias("total_volume"))
    return _ranked(per_ticker, "total_volume", "stock_ticker")


@reads("stock_sector", "stock_price")
def price_by_sector(stocks: DataFrame) -> DataFrame:
    per_sector = stocks.groupBy("stock_sector").agg(exact_avg("stock_price").alias("average_price"))
    return _ranked(per_sector, "average_price", "stock_sector")


def price_by_onehot(frame: DataFrame, prefix: str = "sector_", logged: str = "stock_price") -> DataFrame:
    """Mean price for each one-hot column named `prefix<value>`.

    One aggregate row holds a conditional mean per flag; that row is then turned
    into one row per flag. The original price undoes the log1p of `logged`.
    """
    flags = [c for c in frame.columns if c.startswith(prefix)]
    if not flags:
        raise ValueError(f"no column starts with {prefix!r}")
    means = []
    for flag in flags:
        chosen = F.when(F.col(flag) == 1, F.col(logged))
        means.append(
            F.struct(
                F.lit(flag[len(prefix):]).alias("sector"),
                F.avg(F.expm1(chosen)).alias("avg_price_original"),
                F.avg(chosen).alias("avg_price_logged"),
            )
        )
    rows = frame.agg(F.array(*means).alias("rows")).select(F.inline("rows"))
    return rows.filter(F.col("avg_price_logged").isNotNull())


@reads("is_weekend", "transaction_type")
def weekend_buy_sell(stocks: DataFrame) -> DataFrame:
    counts = (
        stocks.filter("is_weekend")
        .groupBy("transaction_type")
        .agg(F.count("*").alias("transaction_count"))
    )
    return _ranked(counts, "transaction_count", "transaction_type")


@reads("is_weekend")
def weekend_total(stocks: DataFrame) -> DataFrame:
    return stocks.agg(F.count_if("is_weekend").alias("weekend_transactions"))


def _weekend_or_all(groups: DataFrame) -> DataFrame:
    """Weekend groups if there are any, else all groups.

    `groups` carries the measure twice, over all rows (`all_value`) and over the
    weekend (`weekend_value`, with its row count `weekend_rows`), so one pass over
    the fact serves both answers.
    """
    some = groups.agg((F.sum("weekend_rows") > 0).alias("some")).scalar()
    return groups.filter(~F.coalesce(some, F.lit(False)) | (F.col("weekend_rows") > 0)).withColumn(
        "value", F.when(some, F.col("weekend_value")).otherwise(F.col("all_value"))
    )


@reads("is_weekend", "transaction_type")
def weekend_buy_sell_or_all(stocks: DataFrame) -> DataFrame:
    weekend = F.count_if("is_weekend")
    groups = stocks.groupBy("transaction_type").agg(
        F.count("*").alias("all_value"),
        weekend.alias("weekend_value"),
        weekend.alias("weekend_rows"),
    )
    chosen = _weekend_or_all(groups)
    return chosen.select("transaction_type", F.col("value").alias("count")).orderBy("transaction_type")


@reads("customer_id")
def active_customers(stocks: DataFrame, more_than: int = 10) -> DataFrame:
    counts = (
        stocks.groupBy("customer_id")
        .agg(F.count("*").alias("transaction_count"))
        .filter(F.col("transaction_count") > more_than)
    )
    return _ranked(counts, "transaction_count", "customer_id")


@reads("day_name", "total_trade_amount")
def amount_by_day(stocks: DataFrame) -> DataFrame:
    per_day = stocks.groupBy("day_name").agg(exact_sum("total_trade_amount").alias("total_trade_amount"))
    return _ranked(per_day, "total_trade_amount", "day_name")


@reads("timestamp", "total_trade_amount")
def amount_by_day_of_timestamp(stocks: DataFrame) -> DataFrame:
    per_day = stocks.groupBy(day_name("timestamp").alias("day_of_week")).agg(
        exact_sum("total_trade_amount").alias("total_trade_amount")
    )
    return _ranked(per_day, "total_trade_amount", "day_of_week")


@reads("transaction_type")
def transaction_types(stocks: DataFrame) -> DataFrame:
    return stocks.select("transaction_type").distinct()


# --- SQL questions -------------------------------------------------------------

_AMOUNT = exact_sum_sql("total_trade_amount")
_MEAN = exact_avg_sql("total_trade_amount")
_BOUGHT = exact_sum_sql("case when transaction_type = 'BUY' then total_trade_amount else 0 end")
_SOLD = exact_sum_sql("case when transaction_type = 'SELL' then total_trade_amount else 0 end")

TOP_TICKERS = """
select stock_ticker, sum(quantity) as total_quantity
from {stocks}
group by stock_ticker
order by total_quantity desc, stock_ticker
limit 5
"""

AVERAGE_BY_ACCOUNT = f"""
select customer_account_type,
       {_MEAN} as avg_trade_amount,
       count(*) as transaction_count
from {{stocks}}
group by customer_account_type
order by avg_trade_amount desc, customer_account_type
"""

HOLIDAYS_AGAINST_REST = f"""
select case when is_holiday then 'Holiday' else 'Non-Holiday' end as period_type,
       count(*) as transaction_count,
       {_AMOUNT} as total_trade_amount
from {{stocks}}
group by is_holiday
order by is_holiday desc
"""

HOLIDAY_FLAG_COUNTS = f"""
select is_holiday, count(*) as transactions_count from {{stocks}} group by is_holiday
"""

WEEKEND_SECTORS = f"""
select stock_sector,
       sum(quantity) as total_weekend_volume,
       count(*) as weekend_transactions,
       {_AMOUNT} as total_weekend_value
from {{stocks}}
where is_weekend
group by stock_sector
order by total_weekend_volume desc, stock_sector
"""

LIQUIDITY_BY_TYPE = f"""
select stock_liquidity_tier, transaction_type,
       {_AMOUNT} as total_amount,
       count(*) as transaction_count,
       {_MEAN} as avg_amount
from {{stocks}}
group by stock_liquidity_tier, transaction_type
order by stock_liquidity_tier, transaction_type
"""

LIQUIDITY_BUY_SELL = f"""
select stock_liquidity_tier,
       {_BOUGHT} as buy_amount,
       {_SOLD} as sell_amount
from {{stocks}}
group by stock_liquidity_tier
order by stock_liquidity_tier
"""

LIQUIDITY_OVERVIEW = f"""
select stock_liquidity_tier,
       {_BOUGHT} as total_buy_amount,
       {_SOLD} as total_sell_amount,
       {_AMOUNT} as total_amount,
       count(case when transaction_type = 'BUY' then 1 end) as buy_count,
       count(case when transaction_type = 'SELL' then 1 end) as sell_count
from {{stocks}}
group by stock_liquidity_tier
order by total_amount desc, stock_liquidity_tier
"""


def _ask(stocks: DataFrame, text: str) -> DataFrame:
    return stocks.sparkSession.sql(text, stocks=stocks)


@reads("stock_ticker", "quantity")
def sql_top_tickers(stocks: DataFrame) -> DataFrame:
    return _ask(stocks, TOP_TICKERS)


@reads("customer_account_type", "total_trade_amount")
def sql_average_by_account(stocks: DataFrame) -> DataFrame:
    return _ask(stocks, AVERAGE_BY_ACCOUNT)


@reads("is_holiday", "total_trade_amount")
def sql_holidays_against_rest(stocks: DataFrame) -> DataFrame:
    return _ask(stocks, HOLIDAYS_AGAINST_REST)


@reads("is_holiday")
def sql_holiday_flag_counts(stocks: DataFrame) -> DataFrame:
    return _ask(stocks, HOLIDAY_FLAG_COUNTS)


@reads("is_weekend", "stock_sector", "quantity", "total_trade_amount")
def sql_weekend_sectors(stocks: DataFrame) -> DataFrame:
    return _ask(stocks, WEEKEND_SECTORS)


@reads("is_weekend", "stock_sector", "quantity")
def sql_weekend_sectors_or_all(stocks: DataFrame) -> DataFrame:
    """Weekend volume by sector; without any weekend row, volume of all known sectors."""
    groups = stocks.groupBy("stock_sector").agg(
        F.sum("quantity").alias("all_value"),
        F.sum(F.when(F.col("is_weekend"), F.col("quantity"))).alias("weekend_value"),
        F.count_if("is_weekend").alias("weekend_rows"),
    )
    chosen = _weekend_or_all(groups).filter(
        F.col("stock_sector").isNotNull() | (F.col("weekend_rows") > 0)
    )
    out = chosen.select("stock_sector", F.col("value").alias("total_volume"))
    return _ranked(out, "total_volume", "stock_sector")


@reads("stock_liquidity_tier", "transaction_type", "total_trade_amount")
def sql_liquidity_by_type(stocks: DataFrame) -> DataFrame:
    return _ask(stocks, LIQUIDITY_BY_TYPE)


@reads("stock_liquidity_tier", "transaction_type", "total_trade_amount")
def sql_liquidity_buy_sell(stocks: DataFrame) -> DataFrame:
    return _ask(stocks, LIQUIDITY_BUY_SELL)


@reads("stock_liquidity_tier", "transaction_type", "total_trade_amount")
def sql_liquidity_overview(stocks: DataFrame) -> DataFrame:
    return _ask(stocks, LIQUIDITY_OVERVIEW)


# --- Analyses ------------------------------------------------------------------


@reads("stock_ticker", "quantity", "stock_price", "total_trade_amount")
def stock_performance(stocks: DataFrame) -> DataFrame:
    per_ticker = stocks.groupBy("stock_ticker").agg(
        F.count("*").alias("total_transactions"),
        F.sum("quantity").alias("total_volume"),
        exact_avg("stock_price").alias("avg_price"),
        F.max("stock_price").alias("max_price"),
        F.min("stock_price").alias("min_price"),
        F.stddev_samp("stock_price").alias("price_volatility"),
        exact_sum("total_trade_amount").alias("total_value"),
    )
    return _ranked(per_ticker, "total_value", "stock_ticker")


@reads("stock_sector", "stock_ticker", "stock_price", "total_trade_amount")
def sector_analysis(stocks: DataFrame) -> DataFrame:
    """`unique_stocks` counts distinct tickers, as its name says."""
    per_sector = stocks.groupBy("stock_sector").agg(
        F.count("*").alias("total_transactions"),
        exact_sum("total_trade_amount").alias("total_value"),
        exact_avg("stock_price").alias("avg_price"),
        F.count_distinct("stock_ticker").alias("unique_stocks"),
    )
    return _ranked(per_sector, "total_value", "stock_sector")


@reads("customer_account_type", "customer_id", "quantity", "total_trade_amount")
def customer_type_analysis(stocks: DataFrame) -> DataFrame:
    """`unique_customers` counts distinct customers, as its name says."""
    per_type = stocks.groupBy("customer_account_type").agg(
        F.count("*").alias("total_transactions"),
        exact_sum("total_trade_amount").alias("total_value"),
        exact_avg("quantity").alias("avg_quantity"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )
    return _ranked(per_type, "total_value", "customer_account_type")


@reads("day_name", "is_weekend", "stock_price", "total_trade_amount")
def temporal_analysis(stocks: DataFrame) -> DataFrame:
    per_day = stocks.groupBy("day_name", "is_weekend").agg(
        F.count("*").alias("total_transactions"),
        exact_sum("total_trade_amount").alias("total_value"),
        exact_avg("stock_price").alias("avg_price"),
    )
    return _ranked(per_day, "total_transactions", "day_name", "is_weekend")
