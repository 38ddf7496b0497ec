"""The dashboard's filters as one predicate."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import one_of, within_days


def choose(
    fact: DataFrame,
    days: tuple[dt.date | str, dt.date | str] | None = None,
    tickers: Sequence[str] | None = None,
    sectors: Sequence[str] | None = None,
    industries: Sequence[str] | None = None,
    account_type: str = "All",
    transaction_type: str = "All",
) -> DataFrame:
    """Rows that pass every filter given; 'All' or nothing means no restriction."""
    out = fact
    if days is not None:
        out = out.filter(within_days("timestamp", *days))
    for column, chosen in (
        ("stock_ticker", tickers),
        ("stock_sector", sectors),
        ("stock_industry", industries),
        ("customer_account_type", [account_type]),
        ("transaction_type", [transaction_type]),
    ):
        if chosen and "All" not in chosen:
            out = out.filter(one_of(column, chosen))
    return out


def distinct_values(fact: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct known values of each column, in order: (column_name, value)."""
    pairs = fact.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                    for c in columns
                ]
            )
        )
    )
    return pairs.filter("value is not null").distinct().orderBy("column_name", "value")
