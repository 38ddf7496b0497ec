"""Data-quality checks, each in one pass over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.operators.quantiles import exact_quantiles
from tradeloom.sources.scratch import materialize


def column_values(frame: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """Long form (column_name, value) of some columns, NULLs included."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast(kind).alias("value")) for c in columns
    ]
    return frame.select(F.inline(F.array(*pairs)))


def _per_column(frame: DataFrame, columns: Sequence[str], name: str, measure) -> DataFrame:
    """One aggregate row, turned into a row per column."""
    pairs = [F.struct(F.lit(c).alias("column_name"), measure(F.col(f"`{c}`")).alias(name)) for c in columns]
    return frame.agg(F.array(*pairs).alias("pairs")).select(F.inline("pairs"))


def null_counts(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _per_column(frame, columns or frame.columns, "null_count", lambda c: F.count_if(c.isNull()))


def negative_counts(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _per_column(frame, columns, "negative_count", lambda c: F.count_if(c < 0))


def invalid_dates(frame: DataFrame, column: str, pattern: str | None = None) -> DataFrame:
    """Texts that are no timestamp: rows, missing, invalid."""
    fmt = F.lit(pattern) if pattern else None
    parsed = F.try_to_timestamp(F.col(column), fmt) if pattern else F.try_to_timestamp(F.col(column))
    return frame.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(column).isNull()).alias("missing"),
        F.count_if(F.col(column).isNotNull() & parsed.isNull()).alias("invalid"),
    )


def key_mismatch(frame: DataFrame, left: str, right: str) -> DataFrame:
    return frame.filter(F.col(left) != F.col(right))


def duplicate_rows(frame: DataFrame) -> DataFrame:
    """Second and further occurrences of fully equal rows.

    Copies are counted before the shuffle, so a large group of copies stays small.
    """
    repeats = frame.groupBy(*frame.columns).count()
    return repeats.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicate_rows"))


def value_counts(frame: DataFrame, column: str) -> DataFrame:
    return frame.groupBy(column).agg(F.count("*").alias("frequency")).orderBy(column)


def iqr_outliers(
    frame: DataFrame,
    columns: Sequence[str],
    multiplier: float = 1.5,
    threshold: float = 0.1,
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per column: quartiles, bounds, outliers, their share of all rows, and whether
    the share reaches the threshold. Rows without a value count in the share.

    `also` names further aggregates of `value` to take in the same pass.
    """
    quartiles = exact_quantiles(frame, [], columns, {"q1": 0.25, "q3": 0.75}).drop("n")
    reach = multiplier * (F.col("q3") - F.col("q1"))
    bounds = quartiles.withColumns({"lower": F.col("q1") - reach, "upper": F.col("q3") + reach})
    value = F.col("value")
    counted = (
        column_values(frame, columns)
        # One row per column.
        .join(F.broadcast(bounds), "column_name", "left")
        .groupBy("column_name", "q1", "q3", "lower", "upper")
        .agg(
            F.count("*").alias("row_count"),
            F.count_if((value < F.col("lower")) | (value > F.col("upper"))).alias("outlier_count"),
            *[aggregate.alias(name) for name, aggregate in (also or {}).items()],
        )
    )
    share = F.col("outlier_count") / F.col("row_count")
    return counted.withColumn("outlier_share", share).withColumn("flagged", share >= threshold)


def z_outliers(frame: DataFrame, columns: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Values further than `limit` population deviations from the mean, per column."""
    value = F.col("value")
    long = column_values(frame, columns)
    moments = long.groupBy("column_name").agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("deviation")
    )
    distance = F.abs(F.try_divide(value - F.col("mean"), F.col("deviation")))
    # One row per column.
    return (
        long.join(F.broadcast(moments), "column_name")
        .groupBy("column_name")
        .agg(F.count_if(distance > limit).alias("outlier_count"))
    )


def describe(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per column."""
    value = F.col("value")
    basics = (
        column_values(frame, columns)
        .groupBy("column_name")
        .agg(
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )
    )
    quartiles = exact_quantiles(frame, [], columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75}).drop("n")
    return basics.join(quartiles, "column_name", "left")


def column_types(frame: DataFrame) -> DataFrame:
    """Name, type and nullability of each column, in order."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(frame.schema.fields)]
    return frame.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean"
    )


def _is_category(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.StringType, T.BooleanType))


def _is_number(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def profile(frame: DataFrame, common: int = 5, approximate: bool = False) -> DataFrame:
    """One row per column: row_count, unique_values, null_count; texts and flags with
    their most common values; numbers with min and max.

    Values are counted by 128 bits of their hash, so a column of long and near-unique texts
    is shuffled as narrowly as a number; the texts of the most common ones are looked up in a
    further scan. `approximate` replaces the exact distinct count by a sketch and then only
    ranks the texts and flags.
    """
    fields = frame.schema.fields
    numbers = [f.name for f in fields if _is_number(f)]
    categories = [f.name for f in fields if _is_category(f)]
    counted = categories if approximate else [f.name for f in fields]
    values = _hashed(frame, counted).select("column_name", *_HASH).filter(F.col("_a").isNotNull())
    counts = materialize(values.groupBy("column_name", *_HASH).agg(F.count("*").alias("n")), "profile")
    ranked = _most_common(frame, counts, categories, common) if categories else None

    def facts(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        low, high = (F.min(c), F.max(c)) if f.name in numbers else (F.lit(None), F.lit(None))
        entries = [
            F.lit(f.name).alias("column_name"),
            F.count("*").alias("row_count"),
            F.count_if(c.isNull()).alias("null_count"),
            low.cast("double").alias("min_value"),
            high.cast("double").alias("max_value"),
        ]
        if approximate:
            entries.append(F.approx_count_distinct(c).alias("unique_values"))
        return F.struct(*entries)

    ranges = frame.agg(F.array(*[facts(f) for f in fields]).alias("facts")).select(F.inline("facts"))
    if not approximate:
        distinct = counts.groupBy("column_name").agg(F.count("*").alias("unique_values"))
        ranges = ranges.join(distinct, "column_name", "left").na.fill(0, ["unique_values"])
    if ranked is None:
        ranges = ranges.withColumn("common_values", F.lit(None).cast("string"))
    else:
        ranges = ranges.join(ranked, "column_name", "left")
    return ranges.select(
        "column_name", "row_count", "unique_values", "null_count", "common_values", "min_value", "max_value"
    )


_HASH = ["_a", "_b"]
# Values of a column that are looked up by sending their hashes to all tasks at most.
FEW_VALUES = 1000


def _hashed(frame: DataFrame, columns: Sequence[str], text: bool = False) -> DataFrame:
    """One row per cell: column_name, hashes of the value, NULL for NULL, and if asked its text."""
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    cells = []
    for name in columns:
        c = F.col(f"`{name}`")
        if isinstance(kinds[name], (T.DoubleType, T.FloatType)):
            c = c + F.lit(0.0)  # one zero
        entry = [F.lit(name).alias("column_name")]
        entry += [F.when(c.isNotNull(), h).alias(n) for n, h in zip(_HASH, (F.xxhash64(c), F.xxhash64(F.lit(1), c)))]
        cells.append(F.struct(*entry, c.cast("string").alias("value")) if text else F.struct(*entry))
    return frame.select(F.inline(F.array(*cells)))


def _most_common(frame: DataFrame, counts: DataFrame, columns: Sequence[str], common: int) -> DataFrame:
    """`column_name`, `common_values`: by count, of equally frequent ones the first by value.

    The count of the last place tells which values can be among them: those above it, and
    those that tie with it. Where these are few they are picked out of the rows; where all
    others occur once, the first ones by value are, in tasks before they are shuffled.
    """
    known = counts.where(F.col("column_name").isin(list(columns)))
    place = Window.partitionBy("column_name").orderBy(F.desc("n"))
    last = known.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= common)
    last = last.groupBy("column_name").agg(F.min("n").alias("_last"))
    # One row per column.
    ties = known.join(F.broadcast(last), "column_name").where(F.col("n") >= F.col("_last"))
    shape = ties.groupBy("column_name", "_last").agg(F.count("*").alias("size")).collect()
    few = [r.column_name for r in shape if r["size"] <= FEW_VALUES]
    once = [r.column_name for r in shape if r["size"] > FEW_VALUES and r["_last"] == 1]
    many = [r.column_name for r in shape if r["size"] > FEW_VALUES and r["_last"] > 1]
    key = ["column_name", *_HASH]
    found = []

    def texts(names: Sequence[str]) -> DataFrame:
        return _hashed(frame, names, text=True).where(F.col("_a").isNotNull())

    if few:
        picked = F.broadcast(ties.where(F.col("column_name").isin(few)).select(*key, "n"))
        rows = texts(few).join(picked, key)
        found.append(rows.groupBy(*key, "n").agg(F.min("value").alias("value")).select("column_name", "value", "n"))
    if once:
        above = ties.where(F.col("column_name").isin(once) & (F.col("n") > 1)).select(*key, "n")  # fewer than `common` each
        rows = texts(once).join(F.broadcast(above), key, "left")
        more = rows.where(F.col("n").isNotNull()).groupBy(*key, "n").agg(F.min("value").alias("value"))
        first = F.row_number().over(Window.partitionBy("column_name").orderBy("value"))
        single = rows.where(F.col("n").isNull()).select("column_name", "value").withColumn("_place", first)
        found.append(more.select("column_name", "value", "n"))
        found.append(single.where(F.col("_place") <= common).select("column_name", "value", F.lit(1).cast("bigint").alias("n")))
    if many:
        rows = texts(many).join(ties.where(F.col("column_name").isin(many)).select(*key, "n"), key)
        found.append(rows.groupBy(*key, "n").agg(F.min("value").alias("value")).select("column_name", "value", "n"))
    if not found:
        return known.sparkSession.createDataFrame([], "column_name string, common_values string")
    order = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    best = reduce(DataFrame.union, found).withColumn("place", F.row_number().over(order)).where(F.col("place") <= common)
    listed = best.groupBy("column_name").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("ranked"))
    return listed.select("column_name", F.array_join(F.col("ranked.value"), "|").alias("common_values"))
