"""Streaming queries: encode and append, and the monitor."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradeloom.operators.encode import UNSEEN, encode, unseen_counts
from tradeloom.sources.lookups import Lookups
from tradeloom.streaming.appends import AppendTable, Snapshots
from tradeloom.streaming.messages import parse

# Batches of the monitor after which closed hours are gathered into one directory.
GATHER = 16


def append_encoded(
    messages: DataFrame,
    lookups: Lookups,
    schema: T.StructType,
    table_path: str,
    checkpoint: str,
    quarantine_path: str,
) -> StreamingQuery:
    """Start appending encoded records to the table at `table_path`, broken messages to the quarantine.

    Messages are parsed once. Unseen and missing categories become -1; how many there were is
    counted while a batch is written and kept with it. Records, quarantine and counts of a
    batch are committed together, see `appends`; the checkpoint names the stream there, so a
    batch that is run again is known. The query stops when the source is drained.
    """

    def write(batch: DataFrame, number: int) -> None:
        table = AppendTable(batch.sparkSession, table_path)
        if table.holds(checkpoint, number):
            return
        batch = batch.persist()
        try:
            bad, seen = f"{quarantine_path}/{uuid.uuid4().hex}", Observation()
            broken = batch.filter("broken").select("value")
            broken.observe(seen, F.count(F.lit(1)).alias("broken")).write.text(bad)
            good = encode(batch.filter(~F.col("broken")).select("record.*"), lookups, null_code=UNSEEN)
            known = {"quarantine": bad, "broken": int(seen.get["broken"])}
            table.append(good, checkpoint, number, unseen_counts(good), known)
        finally:
            batch.unpersist()

    return (
        parse(messages, schema)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def read_appended(spark: SparkSession, table_path: str) -> DataFrame:
    """The records of the committed batches."""
    return AppendTable(spark, table_path).read()


def read_quarantined(spark: SparkSession, table_path: str) -> DataFrame:
    """`value`: the broken messages of the committed batches."""
    parts = AppendTable(spark, table_path).parts()
    paths = [p["quarantine"] for p in parts if p.get("quarantine")] + [q for p in parts for q in p.get("quarantines", [])]
    return spark.read.text(paths) if paths else spark.createDataFrame([], "value string")


def unseen(spark: SparkSession, table_path: str) -> DataFrame:
    """`column_name`, `unseen`: categories coded -1 in the committed batches."""
    rows = sorted(AppendTable(spark, table_path).facts().items())
    return spark.createDataFrame(rows, "column_name string, unseen bigint")


def drain(stream: DataFrame, path: str, checkpoint: str, format: str) -> StreamingQuery:
    """Append what the source holds to files, then stop."""
    return (
        stream.writeStream.format(format)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def finish(queries: list[StreamingQuery]) -> None:
    for query in queries:
        query.awaitTermination()


def hourly_counts(frame: DataFrame, time: str = "ts", *keys: str) -> DataFrame:
    """Rows per hour and per key."""
    return frame.groupBy(F.date_trunc("hour", time).alias("hour"), *keys).agg(F.count("*").alias("trades"))


def count_hours(
    stream: DataFrame, path: str, checkpoint: str, time: str = "ts", *keys: str, delay: dt.timedelta = dt.timedelta(hours=2)
) -> StreamingQuery:
    """Count rows per hour and key by event time.

    The watermark is the latest time of the earlier batches less `delay`. Hours behind it are
    closed: they leave the state, which so holds the hours of the delay only, however long the
    stream runs. Rows of closed hours are late; an engine's own window would drop them, here
    they are diverted into counts of their own, which readers add. State, closed and late
    counts of a batch are one directory and are committed together with the watermark, so a
    batch that is run again does nothing. From time to time closed and late counts are
    gathered into one directory, with a row per hour and key.
    """

    # Names of own columns that no key has.
    kind, late = ("".join([n, *(["_"] * sum(k.rstrip("_") == n for k in keys))]) for n in ("kind", "late"))

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        snapshots = Snapshots(spark, f"{path}/snapshots")
        old = snapshots.last()
        if number <= old.get("last", -1):
            return
        seen = Observation()
        latest = F.max(F.unix_micros(F.col(time).cast("timestamp"))).alias("latest")
        counts = hourly_counts(batch.observe(seen, latest), time, *keys)
        counts = counts.persist()
        try:
            counts.count()
            mark, reached = old.get("watermark"), seen.get["latest"]
            marks = [mark, None if reached is None else reached - delay // dt.timedelta(microseconds=1)]
            new_mark = max((m for m in marks if m is not None), default=None)
            state = counts.withColumn(late, _behind(mark))
            if old.get("state"):
                held = _parts(spark, [old["state"]], kind, ["open"])
                state = state.unionByName(held.withColumn(late, F.lit(False)))
            summed = state.groupBy("hour", *keys, late).agg(F.sum("trades").alias("trades"))
            # An unknown hour can neither be late nor wait for more.
            closed = _behind(new_mark) | F.col("hour").isNull()
            kinds = F.when(F.col(late), "late").when(closed, "closed").otherwise("open")
            folder = f"{path}/counts/{uuid.uuid4().hex}"
            summed.withColumn(kind, kinds).drop(late).write.partitionBy(kind).parquet(folder)
        finally:
            counts.unpersist()
        done = [*old.get("done", []), folder]
        if len(done) >= GATHER:
            gathered = f"{path}/counts/{uuid.uuid4().hex}"
            whole = _added(_parts(spark, done, kind, ["closed", "late"]), *keys)
            whole.withColumn(kind, F.lit("closed")).write.partitionBy(kind).parquet(gathered)
            done = [gathered]
        new = {"version": old["version"] + 1, "last": number, "watermark": new_mark, "state": folder, "done": done, "kind": kind}
        snapshots.put(new)

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def _behind(mark: int | None) -> Column:
    """Whether an hour ends at or before the watermark, in microseconds of 1970."""
    if mark is None:
        return F.lit(False)
    end = F.unix_micros(F.col("hour").cast("timestamp")) + 3_600_000_000
    return F.coalesce(end <= mark, F.lit(False))


def _parts(spark: SparkSession, folders: list[str], kind: str, wanted: list[str]) -> DataFrame:
    """Rows of the wanted kinds in the folders."""
    out = None
    for folder in folders:
        mine = spark.read.parquet(folder).where(F.col(kind).isin(wanted)).drop(kind)
        out = mine if out is None else out.unionByName(mine)
    return out


def _added(counts: DataFrame, *keys: str) -> DataFrame:
    return counts.groupBy("hour", *keys).agg(F.sum("trades").alias("trades"))


def monitor(spark: SparkSession, path: str) -> dict:
    """What the monitor keeps: watermark, folder of the state, folders of closed hours."""
    return Snapshots(spark, f"{path}/snapshots").last()


def all_counts(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """The count of every hour: those closed, what came late to them, and those still open."""
    kept = monitor(spark, path)
    done = _parts(spark, kept["done"], kept["kind"], ["closed", "late"])
    return _added(done.unionByName(_parts(spark, [kept["state"]], kept["kind"], ["open"])), *keys)
