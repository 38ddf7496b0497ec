"""Lookup tables on storage: one directory per encoded column, together the combined table."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.schemas import LOOKUP


class Lookups:
    """The lookups written under a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    @classmethod
    def write(cls, lookup: DataFrame, path: str) -> Lookups:
        lookup.write.mode("overwrite").partitionBy("column_name").parquet(path)
        return cls(lookup.sparkSession, path)

    @cached_property
    def _bytes(self) -> dict[str, int]:
        """Size of each column's lookup in memory, about: 32 bytes an entry and its text.

        There are no more columns than the fact has.
        """
        size = F.sum(F.octet_length("original_value") + 32).alias("size")
        return {r.column_name: r["size"] for r in self.all().groupBy("column_name").agg(size).collect()}

    @property
    def columns(self) -> list[str]:
        """Encoded columns."""
        return sorted(self._bytes)

    def bytes_of(self, column: str) -> int:
        return self._bytes[column]

    def all(self) -> DataFrame:
        return self.spark.read.schema(LOOKUP).parquet(self.path)

    def of(self, column: str) -> DataFrame:
        """Lookup of one column, from its own directory so that its size is known."""
        values = self.spark.read.schema("original_value string, encoded_value bigint")
        return values.parquet(f"{self.path}/column_name={column}").withColumn("column_name", F.lit(column))
