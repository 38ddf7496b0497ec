"""Reproducible split of the fact into a main and a stream part of exact sizes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows are counted by this many further digits of their hash at once, 16**5 counts at most.
DIGITS = 5
# Rows of a bucket that are ranked in one task; larger buckets are counted by further digits.
BUCKET_ROWS = 100_000


def _order(key: str, seed: int) -> Column:
    return F.struct(
        F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))).alias("_h"), F.col(key).cast("string").alias("_k")
    )


def find_cut(keys: DataFrame, key: str, share: float, seed: int) -> tuple[str, str] | None:
    """Hash and key of the last row of the main part, None if that part is empty.

    The cut is located in a histogram of the hashes' first digits, then among the rows
    of one bucket by their next digits, until the bucket is small whatever the number of
    rows. Only the histogram's one bucket and the cut reach the driver.
    """
    if not 0 <= share <= 1:
        raise ValueError("share must lie between 0 and 1")
    hashed = keys.select(_order(key, seed).alias("_o")).select("_o.*")
    prefix, wanted = "", None
    while True:
        inside = hashed.filter(F.col("_h").startswith(prefix)) if prefix else hashed
        counts = inside.groupBy(F.substring("_h", 1, len(prefix) + DIGITS).alias("_b")).agg(F.count("*").alias("_n"))
        if wanted is None:
            rows = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
            wanted = math.floor(rows * (1 - share))
        if wanted == 0:
            return None
        upto = F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
        edge = counts.withColumn("_upto", upto).filter(F.col("_upto") >= wanted).orderBy("_upto").first()
        wanted -= edge["_upto"] - edge["_n"]
        prefix = edge["_b"]
        if edge["_n"] <= BUCKET_ROWS or len(prefix) >= 30:
            break
    place = F.row_number().over(Window.orderBy("_h", "_k"))
    last = hashed.filter(F.col("_h").startswith(prefix)).withColumn("_place", place).filter(F.col("_place") == wanted)
    row = last.first()
    return row["_h"], row["_k"]


def mark_stream(
    frame: DataFrame,
    key: str = "transaction_id",
    share: float = 0.05,
    seed: int = 42,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Adds `is_stream`, true for the last n - floor(n * (1 - share)) rows in hash order.

    Rows are ordered by md5(seed:key); `key` must be unique. The data is only compared
    with the cut: it is not shuffled, and the parts need not be written. `keys` may
    offer the same keys from a cheaper frame, to locate the cut without the joins
    behind `frame`.
    """
    cut = find_cut(frame if keys is None else keys, key, share, seed)
    if cut is None:
        return frame.withColumn("is_stream", F.lit(True))
    last = F.struct(F.lit(cut[0]).alias("_h"), F.lit(cut[1]).alias("_k"))
    return frame.withColumn("is_stream", F.coalesce(_order(key, seed) > last, F.lit(True)))


def split_for_streaming(
    frame: DataFrame,
    key: str = "transaction_id",
    share: float = 0.05,
    seed: int = 42,
    keys: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(main, stream): disjoint, together the whole frame; the cut is located once."""
    marked = mark_stream(frame, key, share, seed, keys)
    return (
        marked.filter(~F.col("is_stream")).drop("is_stream"),
        marked.filter("is_stream").drop("is_stream"),
    )


def write_split(
    frame: DataFrame,
    path: str,
    key: str = "transaction_id",
    share: float = 0.05,
    seed: int = 42,
    keys: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(main, stream) as tables: one pass writes both, each is read back on its own."""
    marked = mark_stream(frame, key, share, seed, keys)
    marked.write.partitionBy("is_stream").parquet(path)
    both = frame.sparkSession.read.schema(marked.schema).parquet(path)
    return (
        both.filter(~F.col("is_stream")).drop("is_stream"),
        both.filter("is_stream").drop("is_stream"),
    )
