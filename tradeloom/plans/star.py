"""The trade star schema as views over the order tables.

| star         | built from                                                     |
|--------------|----------------------------------------------------------------|
| trades       | lineitem, left-joined to orders for timestamp and customer     |
| customers    | customer                                                       |
| stocks       | part                                                           |
| calendar     | a rule: one row per day                                        |
| price panel  | mean traded price per day and brand, half-up to 4 decimals     |

`fact` adds only the joins whose columns are asked for. Every dimension is left
joined on its primary key, so a join neither drops nor repeats trades and leaving
one out cannot change the other columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.columns import day_name
from tradeloom.schemas import FACT_COLUMNS

# Fixed month-days that count as holidays.
HOLIDAYS = ["01-01", "05-01", "07-04", "12-25"]
# Most days of a calendar and most columns of a panel; more are refused.
MOST_DAYS, MOST_COLUMNS = 400_000, 2000

_FROM_ORDERS = ["timestamp", "date", "customer_id", "average_trade_size"]
_FROM_CALENDAR = {"day_name", "is_weekend", "is_holiday"}
_FROM_CUSTOMER = {"customer_account_type"}
_FROM_STOCK = {"stock_liquidity_tier", "stock_sector", "stock_industry"}

_TICKS = 10000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ticker(part_key: str) -> Column:
    """STK and the key with leading zeros to 12 digits; longer keys stay whole."""
    key = F.col(part_key).cast("string")
    return F.concat(F.lit("STK"), F.when(F.length(key) < 12, F.lpad(key, 12, "0")).otherwise(key))


def few_values(frame: DataFrame, column: str, most: int = MOST_COLUMNS) -> list[str]:
    """The known values of a column that become columns, in order; too many are an error."""
    rows = frame.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column} has more than {most} values")
    return [r[0] for r in rows]


def brands(spark: SparkSession, sf_dir: str) -> list[str]:
    """Tickers of the price panel, one column each."""
    return few_values(read(spark, sf_dir, "part"), "p_brand")


def sectors(spark: SparkSession, sf_dir: str) -> list[str]:
    return few_values(read(spark, sf_dir, "part"), "p_type")


def price_ticks() -> Column:
    """Price per unit in 1/10 000, rounded half up in integers so it is exact."""
    return F.expr(
        "(floor(l_extendedprice * 100 + 0.5D) * 200 + cast(l_quantity as bigint))"
        " div nullif(2 * cast(l_quantity as bigint), 0)"
    )


def transaction_id() -> Column:
    """Unique text key of a line item."""
    return F.concat_ws(
        "-",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.floor(F.col("l_extendedprice") * 100 + 0.5),
        F.col("l_quantity").cast("bigint"),
        F.to_date("l_shipdate"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day from the first order to the last.

    The span is read first and checked, so the calendar has MOST_DAYS rows at most and
    may be broadcast.
    """
    order = F.to_date("o_orderdate")
    span = read(spark, sf_dir, "orders").agg(F.min(order).alias("first"), F.max(order).alias("last")).first()
    n = (span["last"] - span["first"]).days + 1 if span["first"] else 0
    if n > MOST_DAYS:
        raise ValueError(f"orders span {n} days, more than {MOST_DAYS}")
    date = F.date_add(F.lit(span["first"]).cast("date"), F.col("id").cast("int"))
    days = spark.range(0, n, numPartitions=1).select(date.alias("date"))
    return days.select(
        "date",
        day_name("date").alias("day_name"),
        (F.weekday("date") >= 5).alias("is_weekend"),
        F.date_format("date", "MM-dd").isin(HOLIDAYS).alias("is_holiday"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("account_type")
    )


def liquidity_tier() -> Column:
    """A part's tier, by thirds of the sizes."""
    size = F.col("p_size")
    return F.when(size <= 16, "Low").when(size <= 33, "Mid").otherwise("High")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        "p_partkey",
        liquidity_tier().alias("liquidity_tier"),
        F.col("p_type").alias("sector"),
        F.col("p_brand").alias("industry"),
    )


def stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ticker("p_partkey").alias("stock_ticker")
    return _parts(spark, sf_dir).select(key, "liquidity_tier", "sector", "industry")


def _orders(spark: SparkSession, sf_dir: str, with_calendar: bool, with_customers: bool) -> DataFrame:
    """What a trade takes from its order.

    Calendar and customer hang on the order, so they join the orders, several times
    fewer than the trades: the fact is then not shuffled by customer.
    """
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey"),
        F.col("o_orderdate").alias("timestamp"),
        F.to_date("o_orderdate").alias("date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("average_trade_size"),
    )
    if with_calendar:
        orders = orders.join(F.broadcast(calendar(spark, sf_dir)), "date", "left")
    if with_customers:
        who = customers(spark, sf_dir).withColumnRenamed("account_type", "customer_account_type")
        orders = orders.join(who, "customer_id", "left")
    return orders


def _lines() -> list[Column]:
    """What a trade takes from its line item."""
    return [
        transaction_id().alias("transaction_id"),
        ticker("l_partkey").alias("stock_ticker"),
        F.when(F.col("l_returnflag") == "R", "SELL").otherwise("BUY").alias("transaction_type"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (price_ticks() / _TICKS).alias("stock_price"),
        F.col("l_extendedprice").alias("total_trade_amount"),
    ]


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades with every column the line item and its order offer."""
    lines = read(spark, sf_dir, "lineitem")
    orders = _orders(spark, sf_dir, with_calendar=False, with_customers=False)
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.select(*_lines(), *_FROM_ORDERS)


def fact(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The decoded fact, restricted to `columns` (all sixteen by default)."""
    wanted = list(columns) or FACT_COLUMNS
    need = set(wanted)
    frame = read(spark, sf_dir, "lineitem")
    ordered: list[str] = []
    if need & {*_FROM_ORDERS, *_FROM_CALENDAR, *_FROM_CUSTOMER}:
        orders = _orders(spark, sf_dir, bool(need & _FROM_CALENDAR), bool(need & _FROM_CUSTOMER))
        frame = frame.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        ordered = [c for c in orders.columns if c != "o_orderkey"]
    hung: list[str] = []
    if need & _FROM_STOCK:
        # On the numeric key, which is shorter to shuffle than the ticker made from it.
        parts = _parts(spark, sf_dir).withColumnsRenamed(
            {
                "liquidity_tier": "stock_liquidity_tier",
                "sector": "stock_sector",
                "industry": "stock_industry",
            }
        )
        frame = frame.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        hung = sorted(_FROM_STOCK)
    frame = frame.select(*_lines(), *ordered, *hung)
    return frame.select(*wanted)


def observed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean price per day and brand, exact to 4 decimals: (date, stock_ticker, stock_price).

    Holds at most one row per calendar day and brand.
    """
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", price_ticks().alias("ticks"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    parts = read(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("stock_ticker"))
    per_cell = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("date", "stock_ticker")
        .agg(F.sum("ticks").alias("total"), F.count("ticks").alias("n"))
    )
    return per_cell.select(
        "date", "stock_ticker", (F.expr("(2 * total + n) div (2 * n)") / _TICKS).alias("stock_price")
    )


def price_panel(spark: SparkSession, sf_dir: str, tickers: list[str] | None = None) -> DataFrame:
    """Wide panel: `date` and one column per brand, NULL where a brand did not trade."""
    return (
        observed_prices(spark, sf_dir)
        .groupBy("date")
        .pivot("stock_ticker", brands(spark, sf_dir) if tickers is None else tickers)
        .agg(F.first("stock_price"))
    )


def brand_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades at the level of the price panel: the ticker is the brand."""
    columns = ["transaction_id", "timestamp", "date", "customer_id", "transaction_type", "quantity"]
    return fact(spark, sf_dir, *columns, "stock_industry").withColumnRenamed("stock_industry", "stock_ticker")
