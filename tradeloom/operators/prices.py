"""The price panel: reshaping and filling.

The long form (date, stock_ticker, stock_price) has one row per day and ticker,
so a window per ticker never holds more rows than the calendar has days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def melt(wide: DataFrame, tickers: Sequence[str] | None = None) -> DataFrame:
    """One row per day and ticker, prices not known included."""
    names = list(tickers) if tickers else [c for c in wide.columns if c != "date"]
    return wide.unpivot("date", names, "stock_ticker", "stock_price")


def widen(long: DataFrame, tickers: Sequence[str]) -> DataFrame:
    """Inverse of melt."""
    return long.groupBy("date").pivot("stock_ticker", list(tickers)).agg(F.first("stock_price"))


def fill_prices(long: DataFrame, method: str = "ffill") -> DataFrame:
    """Fill unknown prices per ticker along the dates.

    ffill        last known price, leading gap from the first known one
    bfill        next known price, trailing gap from the last known one
    interpolate  linear by row position between known prices, flat at both ends
    """
    by_date = Window.partitionBy("stock_ticker").orderBy("date")
    until = by_date.rowsBetween(Window.unboundedPreceding, 0)
    # The next value is the last one seen coming from the end: a running frame, where
    # a frame up to the end would start over for each row.
    onward = (
        Window.partitionBy("stock_ticker")
        .orderBy(F.desc("date"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    price = F.col("stock_price")
    if method in ("ffill", "bfill"):
        last, first = F.last(price, True).over(until), F.last(price, True).over(onward)
        filled = F.coalesce(last, first) if method == "ffill" else F.coalesce(first, last)
        return long.withColumn("stock_price", filled)
    if method == "interpolate":
        numbered = long.withColumn("_at", F.row_number().over(by_date))
        known = F.when(price.isNotNull(), F.struct(F.col("_at").alias("at"), price.alias("price")))
        ends = numbered.withColumns(
            {"_a": F.last(known, True).over(until), "_b": F.last(known, True).over(onward)}
        )
        a, b = F.col("_a"), F.col("_b")
        share = F.try_divide(F.col("_at") - a["at"], b["at"] - a["at"])
        line = a["price"] + (b["price"] - a["price"]) * share
        return ends.withColumn("stock_price", F.coalesce(price, line, a["price"], b["price"])).drop(
            "_at", "_a", "_b"
        )
    raise ValueError(f"unknown fill method {method!r}")
