"""Warehouse tables over JDBC. The driver jar comes with the cluster."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Fixed meaning of the write modes.
MODES = {"replace": "overwrite", "append": "append", "fail": "error"}


@dataclass(frozen=True)
class Warehouse:
    """Connection of a warehouse; `split` names a numeric column for parallel reads."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    batch_rows: int = 1000
    fetch_rows: int = 10000

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "batchsize": str(self.batch_rows),
            "fetchsize": str(self.fetch_rows),
        }

    def read_options(
        self,
        table: str | None = None,
        query: str | None = None,
        split: tuple[str, int, int, int] | None = None,
    ) -> dict[str, str]:
        """Exactly one of table and query.

        `split` = (column, lowest, highest, partitions) reads a table in parallel
        ranges; a single connection could not deliver a large one.
        """
        if (table is None) == (query is None):
            raise ValueError("give either a table or a query")
        options = self.options()
        if split is None:
            options |= {"dbtable": table} if table else {"query": query}
            return options
        column, low, high, partitions = split
        source = table if table else f"({query}) as source"
        return options | {
            "dbtable": source,
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }


def read(spark: SparkSession, warehouse: Warehouse, **what) -> DataFrame:
    return spark.read.format("jdbc").options(**warehouse.read_options(**what)).load()


def write(frame: DataFrame, warehouse: Warehouse, table: str, if_exists: str = "replace") -> None:
    """Write, then compare the number of rows read back with the number written.

    The rows are counted while they are written, so the plan behind `frame` runs once.
    """
    mode = write_mode(if_exists)
    spark = frame.sparkSession
    before = 0
    if if_exists == "append":
        before = read(spark, warehouse, table=table).count()
    seen = Observation()
    counted = frame.observe(seen, F.count(F.lit(1)).alias("rows"))
    save(counted, warehouse.options() | {"dbtable": table}, mode)
    found = read(spark, warehouse, table=table).count() - before
    check_written(seen.get["rows"], found, table)


def save(frame: DataFrame, options: dict[str, str], mode: str) -> None:
    frame.write.format("jdbc").options(**options).mode(mode).save()


def write_mode(if_exists: str) -> str:
    if if_exists not in MODES:
        raise ValueError(f"unknown mode {if_exists!r}, expected one of {tuple(MODES)}")
    return MODES[if_exists]


def check_written(expected: int, found: int, table: str) -> None:
    if expected != found:
        raise RuntimeError(f"{table}: wrote {expected} rows but found {found}")
