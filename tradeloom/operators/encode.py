"""Label codes: fit lookups, encode, decode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.operators.ordered import running_count
from tradeloom.schemas import FLAG_COLUMNS, LABEL_COLUMNS
from tradeloom.sources.lookups import Lookups
from tradeloom.sources.scratch import fresh_path

UNSEEN = -1
# Bytes of a lookup's values and codes that are sent to every task at most.
SENT_BYTES = 8 << 20
# Parts a frequent value is dealt into where its lookup is larger.
SALTS = 16


def fit_labels(
    fact: DataFrame,
    columns: Sequence[str] = LABEL_COLUMNS,
    flags: Sequence[str] = FLAG_COLUMNS,
) -> DataFrame:
    """Lookup rows (column_name, original_value, encoded_value).

    A label's code is its 0-based rank among the sorted known values of its column.
    The ranks are counted along a range partitioning, so a column with billions of
    values is spread over all tasks. Flags map to themselves.
    """
    labels = [c for c in columns if c in fact.columns]
    bits = [c for c in flags if c in fact.columns]
    entries = [_entry(c, F.col(c)) for c in labels] + [_entry(c, F.col(c).cast("int")) for c in bits]
    values = fact.select(F.inline(F.array(*entries)))
    distinct = values.filter("original_value is not null").distinct().withColumn("n", F.lit(1))
    ranked = running_count(distinct, ["column_name"], "original_value", "n", "upto")
    code = F.when(F.col("column_name").isin(bits), F.col("original_value").try_cast("bigint")).otherwise(
        F.col("upto") - 1
    )
    return ranked.select("column_name", "original_value", code.cast("bigint").alias("encoded_value"))


def fit_lookups(fact: DataFrame, path: str | None = None, **kinds) -> Lookups:
    """fit_labels written to `path` (a scratch path by default)."""
    spark = fact.sparkSession
    return Lookups.write(fit_labels(fact, **kinds), path or fresh_path(spark, "lookups"))


def encode(
    fact: DataFrame, lookups: Lookups, null_code: int | None = None, columns: Sequence[str] = LABEL_COLUMNS
) -> DataFrame:
    """Values to codes: unseen values become -1, NULLs become `null_code`, flags 0/1.

    Batch encoding keeps NULLs, the stream codes them as -1. Lookups of checked size are sent
    to all tasks, so the rows are scanned once and not shuffled for them; see `_looked_up`.
    """
    out = fact
    # Codes are narrower than values, so what is joined last, by a shuffle, moves codes.
    for c in _by_size([c for c in columns if c in fact.columns], lookups):
        missing = F.when(F.col(c).isNull(), F.lit(null_code).cast("bigint"))
        if c not in lookups.columns:
            # Nothing was known when the lookups were fitted, so every value is unseen.
            out = out.withColumn(c, missing.otherwise(F.lit(UNSEEN).cast("bigint")))
            continue
        code = missing.otherwise(F.coalesce("_found", F.lit(UNSEEN).cast("bigint")))
        out = _looked_up(out, c, lookups, "original_value", "encoded_value").withColumn(c, code).drop("_found")
    return out.withColumns({c: _flag_code(c, null_code) for c in FLAG_COLUMNS if c in fact.columns})


def decode(encoded: DataFrame, lookups: Lookups, columns: Sequence[str] = LABEL_COLUMNS) -> DataFrame:
    """Codes back to values; a code without a value stays, as text. Flags become booleans."""
    out = encoded
    for c in reversed(_by_size([c for c in columns if c in encoded.columns and c in lookups.columns], lookups)):
        value = F.coalesce("_found", F.col(c).cast("string"))
        out = _looked_up(out, c, lookups, "encoded_value", "original_value").withColumn(c, value).drop("_found")
    flags = {c: F.when(F.col(c) >= 0, F.col(c) == 1) for c in FLAG_COLUMNS if c in encoded.columns}
    return out.withColumns(flags)


def _by_size(columns: Sequence[str], lookups: Lookups) -> list[str]:
    return sorted(columns, key=lambda c: lookups.bytes_of(c) if c in lookups.columns else 0)


def _looked_up(frame: DataFrame, column: str, lookups: Lookups, key: str, value: str) -> DataFrame:
    """Adds `_found`: what the column's lookup has at `value` for the column's value at `key`.

    A lookup of at most SENT_BYTES goes to all tasks. A larger one is joined on the value and
    a salt made of the whole row, each entry once per salt: neither a frequent value nor the
    NULLs of a column, which match nothing, then meet in one task. That also holds on streams,
    where nothing splits a skewed partition.
    """
    table = lookups.of(column).select(F.col(key).alias("_key"), F.col(value).alias("_found"))
    if lookups.bytes_of(column) <= SENT_BYTES:
        return frame.join(F.broadcast(table), F.col(column) == F.col("_key"), "left").drop("_key")
    salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("_its_salt")
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in frame.columns]), F.lit(SALTS)).cast("int")
    salted = table.select("_key", "_found", salts)
    match = (F.col(column) == F.col("_key")) & (F.col("_salt") == F.col("_its_salt"))
    return frame.withColumn("_salt", salt).join(salted, match, "left").drop("_key", "_salt", "_its_salt")


def with_date_parts(frame: DataFrame) -> DataFrame:
    """Adds date, year, month and month_name."""
    return frame.withColumns(
        {
            "date": F.to_date("timestamp"),
            "year": F.year("timestamp"),
            "month": F.month("timestamp"),
            "month_name": F.date_format("timestamp", "MMMM"),
        }
    )


def unseen_counts(encoded: DataFrame, columns: Sequence[str] = LABEL_COLUMNS) -> dict[str, Column]:
    """Counters of unseen values by column, for observe() or agg()."""
    return {c: F.count_if(F.col(c) == UNSEEN) for c in columns if c in encoded.columns}


def _entry(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("column_name"), value.cast("string").alias("original_value"))


def _flag_code(name: str, null_code: int | None) -> Column:
    return F.coalesce(F.col(name).cast("int"), F.lit(null_code).cast("int"))
