"""Writers. Errors are raised, never swallowed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

FORMATS = ("csv", "parquet", "json")


def save(frame: DataFrame, path: str, format: str = "csv") -> str:
    """Overwrite `path`; every task writes its own file."""
    if format not in FORMATS:
        raise ValueError(f"unknown format {format!r}, expected one of {FORMATS}")
    writer = frame.write.mode("overwrite").format(format)
    if format == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return path


def save_result(frame: DataFrame, path: str, table: str | None = None, format: str = "csv") -> str:
    """Write a result to files and, if named, to a table, computing it once.

    The table is filled from the written files, so the plan behind `frame` does not
    run twice. An empty result keeps its columns in both places.
    """
    spark = frame.sparkSession
    save(frame, path, format)
    if table is not None:
        reader = spark.read.schema(frame.schema)
        if format == "csv":
            reader = reader.option("header", True)
        save_table(reader.format(format).load(path), table, f"{path}-table")
    return path


def save_table(frame: DataFrame, table: str, path: str) -> DataFrame:
    """Overwrite a table of the catalog whose files are at `path`; returns the table."""
    frame.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(table)
    return frame.sparkSession.table(table)


def save_sample(frame: DataFrame, path: str, key: str, n: int = 10) -> str:
    """The first n rows by `key` as CSV."""
    return save(frame.orderBy(key).limit(n), path, "csv")


def save_summary(summary: DataFrame, path: str) -> str:
    """A one-row summary as JSON, unknown values included."""
    summary.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def save_query(spark: SparkSession, text: str, folder: str, name: str | None = None) -> str:
    """Run a query and save its rows as CSV under a name that defaults to the time."""
    label = name or f"query_results_{dt.datetime.now():%Y%m%d_%H%M%S}"
    return save(spark.sql(text), f"{folder}/{label}", "csv")


def append(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """Old and new records by column name; columns one side lacks are NULL there."""
    return new if existing is None else existing.unionByName(new, allowMissingColumns=True)
