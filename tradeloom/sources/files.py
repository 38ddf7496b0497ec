"""Readers for CSV, parquet and JSON."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom import schemas


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One CSV file or directory of them, typed by `schema`."""
    if not path.rstrip("/").lower().endswith(".csv"):
        raise ValueError(f"expected a .csv path, got {path!r}")
    return spark.read.schema(schema).option("header", True).csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV whose types are found by an extra pass; prefer read_csv."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def load_star(spark: SparkSession, folder: str, tickers: Sequence[str], id_type: str = "string") -> dict[str, DataFrame]:
    """The five CSV tables of the star, by name."""
    trades = T.StructType(
        [f if f.name != "transaction_id" else T.StructField(f.name, T._parse_datatype_string(id_type))
         for f in schemas.TRADES_CSV.fields]
    )
    kinds = {
        "dim_customer": schemas.DIM_CUSTOMER,
        "dim_stock": schemas.DIM_STOCK,
        "trades": trades,
        "dim_date": schemas.DIM_DATE,
        "daily_trade_prices": schemas.price_panel_schema(list(tickers)),
    }
    return {name: read_csv(spark, f"{folder}/{name}.csv", schema) for name, schema in kinds.items()}


def register(frame: DataFrame, view: str = "stocks") -> DataFrame:
    """Register a session view for SQL and hand the frame back."""
    frame.createOrReplaceTempView(view)
    return frame


def preview(frame: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The first n rows by `key`."""
    return frame.orderBy(key).limit(n)


def first_available(candidates: Sequence[Callable[[], DataFrame]]) -> DataFrame:
    """The first source that exists, in order of preference.

    A reader of a missing path or table fails while the plan is analysed, before
    any data is read; other errors are not hidden.
    """
    missing: list[str] = []
    for open_source in candidates:
        try:
            frame = open_source()
            frame.schema  # noqa: B018 - analyses the plan
            return frame
        except AnalysisException as error:
            if error.getCondition() not in _NOT_THERE:
                raise
            missing.append(str(error.getCondition()))
    raise FileNotFoundError(f"none of {len(candidates)} sources exists: {missing}")


_NOT_THERE = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"}


def read_query_logs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.QUERY_LOG).json(path)


def latest_logs(logs: DataFrame, n: int = 10) -> DataFrame:
    """The n newest entries; equal times in order of their question."""
    return logs.orderBy(F.desc("timestamp"), "user_query", "execution_time_ms").limit(n)


def read_summary(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def table_info(spark: SparkSession, table: str) -> DataFrame:
    """Row count and columns of a registered table: one row per column."""
    if not spark.catalog.tableExists(table):
        raise ValueError(f"no such table: {table}")
    frame = spark.table(table)
    columns = spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(frame.schema.fields)],
        "position int, column_name string, data_type string, nullable boolean",
    )
    return columns.withColumn("row_count", frame.agg(F.count("*")).scalar())
