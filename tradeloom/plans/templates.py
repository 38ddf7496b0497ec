"""The SELECTs behind the plain-language questions, as named SQL templates.

Each text reads the view `{stocks}`; values that depend on the data are named
parameters. Every LIMIT is preceded by a full sort key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradeloom.functions.columns import exact_avg_sql, exact_sum_sql

_AMOUNT = exact_sum_sql("total_trade_amount")

TEMPLATES: dict[str, str] = {
    "sector_volume": "select sum(quantity) as total_volume from {stocks} where stock_sector = :sector",
    "ticker_volume_top20": (
        "select stock_ticker, sum(quantity) as total_volume from {stocks} "
        "group by stock_ticker order by total_volume desc, stock_ticker limit 20"
    ),
    "sector_avg_price": (
        f"select stock_sector, {exact_avg_sql('stock_price')} as avg_price "
        "from {stocks} group by stock_sector order by avg_price desc, stock_sector"
    ),
    "account_avg_amount": (
        f"select customer_account_type, {exact_avg_sql('total_trade_amount')} as avg_amount "
        "from {stocks} group by customer_account_type"
    ),
    "top10_customers": (
        f"select customer_id, {_AMOUNT} as total_trades from {{stocks}} "
        "group by customer_id order by total_trades desc, customer_id limit 10"
    ),
    "top10_tickers": (
        "select stock_ticker, sum(quantity) as total_volume from {stocks} "
        "group by stock_ticker order by total_volume desc, stock_ticker limit 10"
    ),
    "weekend_types": (
        "select transaction_type, count(*) as count from {stocks} where is_weekend group by transaction_type"
    ),
    "holiday_count": "select count(*) as holiday_trades from {stocks} where is_holiday",
    "sector_default": (
        f"select stock_sector, count(*) as transaction_count, {_AMOUNT} as total_amount "
        "from {stocks} group by stock_sector order by total_amount desc, stock_sector limit 10"
    ),
    "sector_volume_top10": (
        "select stock_sector, sum(quantity) as total_volume from {stocks} "
        "group by stock_sector order by total_volume desc, stock_sector limit 10"
    ),
    "type_by_account": (
        f"select customer_account_type, transaction_type, count(*) as transaction_count, "
        f"{_AMOUNT} as total_amount from {{stocks}} "
        "group by customer_account_type, transaction_type order by customer_account_type, transaction_type"
    ),
    "volume_by_month": (
        "select date_format(timestamp, 'yyyy-MM') as year_month, sum(quantity) as total_volume "
        "from {stocks} group by 1 order by 1"
    ),
    "holiday_rows": (
        "select transaction_id, customer_id, stock_ticker, transaction_type, quantity, total_trade_amount "
        "from {stocks} where is_holiday"
    ),
    "sector_liquidity": (
        "select stock_sector, count(*) as high_tier_trades, sum(quantity) as high_tier_volume "
        "from {stocks} where stock_liquidity_tier = 'High' "
        "group by stock_sector order by high_tier_volume desc, stock_sector"
    ),
    "top10_customers_count": (
        "select customer_id, count(*) as transaction_count from {stocks} "
        "group by customer_id order by transaction_count desc, customer_id limit 10"
    ),
    "weekend_count": "select count(*) as weekend_transactions from {stocks} where is_weekend",
    "weekend_buys": (
        "select count(*) as weekend_buys from {stocks} where is_weekend and transaction_type = 'BUY'"
    ),
    "sector_like": (
        "select stock_sector, count(*) as transaction_count from {stocks} "
        "where stock_sector ilike :pattern group by stock_sector"
    ),
    "sector_and_industry": (
        "select sum(quantity) as total_volume, count(*) as transaction_count from {stocks} "
        "where stock_sector = :sector and stock_industry = :industry"
    ),
}

# Columns each template reads, for callers that build the view on demand.
TEMPLATE_READS: dict[str, tuple[str, ...]] = {
    "sector_volume": ("stock_sector", "quantity"),
    "ticker_volume_top20": ("stock_ticker", "quantity"),
    "sector_avg_price": ("stock_sector", "stock_price"),
    "account_avg_amount": ("customer_account_type", "total_trade_amount"),
    "top10_customers": ("customer_id", "total_trade_amount"),
    "top10_tickers": ("stock_ticker", "quantity"),
    "weekend_types": ("transaction_type", "is_weekend"),
    "holiday_count": ("is_holiday",),
    "sector_default": ("stock_sector", "total_trade_amount"),
    "sector_volume_top10": ("stock_sector", "quantity"),
    "type_by_account": ("customer_account_type", "transaction_type", "total_trade_amount"),
    "volume_by_month": ("timestamp", "quantity"),
    "holiday_rows": (
        "transaction_id",
        "customer_id",
        "stock_ticker",
        "transaction_type",
        "quantity",
        "total_trade_amount",
        "is_holiday",
    ),
    "sector_liquidity": ("stock_sector", "stock_liquidity_tier", "quantity"),
    "top10_customers_count": ("customer_id",),
    "weekend_count": ("is_weekend",),
    "weekend_buys": ("is_weekend", "transaction_type"),
    "sector_like": ("stock_sector",),
    "sector_and_industry": ("stock_sector", "stock_industry", "quantity"),
}


def run_template(name: str, stocks: DataFrame, **values: str) -> DataFrame:
    return stocks.sparkSession.sql(TEMPLATES[name], args=values, stocks=stocks)


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """A user's SELECT over the registered views, with all its rows."""
    return spark.sql(text)


def preview_sql(spark: SparkSession, text: str, rows: int = 1000) -> DataFrame:
    """Some rows of a SELECT for display: the first ones if it is ordered, else any."""
    return spark.sql(text).limit(rows)
