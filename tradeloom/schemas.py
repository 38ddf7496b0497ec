"""Explicit schemas; nothing in the library infers types unless asked to."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed column names and order of the integrated fact.
FACT_COLUMNS = [
    "transaction_id",
    "timestamp",
    "customer_id",
    "stock_ticker",
    "transaction_type",
    "quantity",
    "average_trade_size",
    "stock_price",
    "total_trade_amount",
    "customer_account_type",
    "day_name",
    "is_weekend",
    "is_holiday",
    "stock_liquidity_tier",
    "stock_sector",
    "stock_industry",
]

# Fixed lists of the columns that get label codes and of the flags cast to 0/1.
LABEL_COLUMNS = [
    "stock_ticker",
    "transaction_type",
    "customer_account_type",
    "day_name",
    "stock_sector",
    "stock_industry",
]
FLAG_COLUMNS = ["is_weekend", "is_holiday"]

_FACT_TYPES = {
    "transaction_id": T.StringType(),
    "timestamp": T.TimestampNTZType(),
    "customer_id": T.LongType(),
    "quantity": T.LongType(),
    "average_trade_size": T.DoubleType(),
    "stock_price": T.DoubleType(),
    "total_trade_amount": T.DoubleType(),
    "is_weekend": T.BooleanType(),
    "is_holiday": T.BooleanType(),
}


def fact_schema(id_type: T.DataType | None = None) -> T.StructType:
    """Integrated fact. `id_type` is LONG for feeds that number their trades."""
    kinds = dict(_FACT_TYPES)
    if id_type is not None:
        kinds["transaction_id"] = id_type
    return T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in FACT_COLUMNS])


TRADES_CSV = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("stock_ticker", T.StringType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("average_trade_size", T.DoubleType()),
        T.StructField("cumulative_portfolio_value", T.DoubleType()),
    ]
)

DIM_CUSTOMER = T.StructType(
    [
        T.StructField("customer_key", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("account_type", T.StringType()),
    ]
)

DIM_STOCK = T.StructType(
    [
        T.StructField("stock_key", T.IntegerType()),
        T.StructField("stock_ticker", T.StringType()),
        T.StructField("company_name", T.StringType()),
        T.StructField("liquidity_tier", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField("industry", T.StringType()),
    ]
)

DIM_DATE = T.StructType(
    [
        T.StructField("date_key", T.IntegerType()),
        T.StructField("date", T.DateType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("month_name", T.StringType()),
        T.StructField("quarter", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("day_name", T.StringType()),
        T.StructField("is_weekend", T.BooleanType()),
        T.StructField("is_holiday", T.BooleanType()),
    ]
)

LOOKUP = T.StructType(
    [
        T.StructField("column_name", T.StringType()),
        T.StructField("original_value", T.StringType()),
        T.StructField("encoded_value", T.LongType()),
    ]
)

QUERY_LOG = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("user_query", T.StringType()),
        T.StructField("generated_sql", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("execution_time_ms", T.DoubleType()),
        T.StructField("enhanced_context_used", T.BooleanType()),
        T.StructField("cache_hit", T.BooleanType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


def price_panel_schema(tickers: list[str]) -> T.StructType:
    """Wide price panel: `date` and one nullable price column per ticker."""
    return T.StructType(
        [T.StructField("date", T.DateType())] + [T.StructField(t, T.DoubleType()) for t in tickers]
    )
