"""Streams from files: encoding, end marks, broken messages, restarts."""

import datetime as dt
import json
import os

import pytest
from paths import SMALL
from pyspark.sql import functions as F

from tradeloom.operators import encode
from tradeloom.plans import star
from tradeloom.streaming import jobs, messages
from tradeloom.streaming.appends import AppendTable, Snapshots

COLUMNS = ["transaction_id", "timestamp", "quantity", "stock_sector", "transaction_type", "is_holiday"]


def text(spark, path, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(path)


@pytest.fixture
def lookups(spark):
    return encode.fit_lookups(star.fact(spark, SMALL, "stock_sector", "transaction_type", "is_holiday"))


@pytest.fixture
def schema(spark):
    return star.fact(spark, SMALL, *COLUMNS).schema


def run(spark, lookups, schema, topic, table, progress, bad):
    source = messages.subscribe_files(spark, topic)
    jobs.finish([jobs.append_encoded(source, lookups, schema, table, progress, bad)])


def test_messages_marks_broken_and_restart(spark, fresh, lookups, schema):
    record = {
        "transaction_id": "1", "timestamp": "1997-05-01 00:00:00", "quantity": 3,
        "stock_sector": "PROMO", "transaction_type": "BUY", "is_holiday": True,
    }
    topic, table, progress, bad = (fresh(n) for n in ("topic", "table", "progress", "bad"))
    before = encode.encode(spark.createDataFrame([("0", "kept")], "transaction_id string, batch string"), lookups)
    assert AppendTable(spark, table).append(before)
    text(spark, topic, [
        json.dumps(record),
        json.dumps(record | {"transaction_id": "2", "stock_sector": "Space", "is_holiday": None}),
        json.dumps(record | {"transaction_id": "3", "transaction_type": None}),
        '{"transaction_id": "4", ',
        '"EOS"',
        '{"message": "EOS"}',
    ])
    run(spark, lookups, schema, topic, table, progress, bad)
    whole = lambda: jobs.read_appended(spark.newSession(), table)
    got = {r.transaction_id: r for r in whole().collect()}
    assert set(got) == {"0", "1", "2", "3"}
    assert (got["0"].batch, got["1"].batch, got["0"].quantity) == ("kept", None, None)
    assert {r.column_name: r.unseen for r in jobs.unseen(spark, table).collect()} == {"stock_sector": 1, "transaction_type": 1}
    assert (got["1"].stock_sector, got["1"].transaction_type, got["1"].is_holiday) == (3, 0, 1)
    assert (got["2"].stock_sector, got["2"].is_holiday, got["3"].transaction_type) == (-1, -1, -1)
    assert str(got["1"].timestamp) == "1997-05-01 00:00:00"
    assert [r.value for r in jobs.read_quarantined(spark, table).collect()] == ['{"transaction_id": "4", ']

    run(spark, lookups, schema, topic, table, progress, bad)
    assert whole().count() == 4
    text(spark, topic, [json.dumps(record | {"transaction_id": "5"})])
    run(spark, lookups, schema, topic, table, progress, bad)
    assert whole().count() == 5 and jobs.read_quarantined(spark, table).count() == 1


def test_a_batch_killed_before_its_commit_is_seen_by_nobody(spark, fresh, lookups, schema, monkeypatch):
    rows = star.fact(spark, SMALL, *COLUMNS).limit(50)
    topic = messages.publish_files(rows, fresh("topic"))
    table, progress, bad = (fresh(n) for n in ("table", "progress", "bad"))
    AppendTable(spark, table).append(encode.encode(rows.limit(7), lookups))

    def killed(self, entry):
        raise RuntimeError("killed")

    commit = AppendTable._commit
    monkeypatch.setattr(AppendTable, "_commit", killed)
    with pytest.raises(Exception, match="killed"):
        run(spark, lookups, schema, topic, table, progress, bad)
    assert jobs.read_appended(spark, table).count() == 7
    monkeypatch.setattr(AppendTable, "_commit", commit)
    run(spark, lookups, schema, topic, table, progress, bad)
    assert jobs.read_appended(spark, table).count() == 57
    assert AppendTable(spark, table).audit().where("not matches").isEmpty()

    # The batch is there; a run that has lost its progress but not its name repeats it in vain.
    table_ = AppendTable(spark, table)
    assert table_.holds(progress, 0) and not table_.append(rows, progress, 0)
    assert jobs.read_appended(spark, table).count() == 57


def test_two_writers_and_a_compaction_lose_nothing(spark, fresh):
    a, b = AppendTable(spark, fresh("table")), None
    b = AppendTable(spark, a.path)
    row = lambda i: spark.createDataFrame([(i, f"x{i}")], "batch int, kind string")
    a.append(row(1), facts={"odd": F.sum(F.col("batch") % 2)})
    old = b.snapshots.last()
    a.append(row(2))
    assert not b.snapshots.put({**old, "version": old["version"] + 1})  # the number is taken
    b.append(row(3), "s", 0, {"odd": F.sum(F.col("batch") % 2)})
    assert sorted(r.batch for r in a.read().collect()) == [1, 2, 3]
    a.compact()
    assert len(a.parts()) == 1 and a.facts() == {"odd": 2}
    assert not b.append(row(3), "s", 0) and b.append(row(4), "s", 1)
    assert sorted(r.batch for r in b.read().collect()) == [1, 2, 3, 4]
    assert b.audit().where("not matches").isEmpty()
    found = b.register("appended_rows").collect()
    assert sorted((r.batch, r.kind) for r in found) == [(i, f"x{i}") for i in range(1, 5)]


def test_a_lost_file_shows_in_the_audit(spark, fresh):
    table = AppendTable(spark, fresh("table"))
    table.append(spark.range(10, numPartitions=2).withColumnRenamed("id", "n"))
    table.append(spark.range(6, numPartitions=1).withColumnRenamed("id", "n"), "s", 0)
    assert {(r.stream, r.processed, r.stored, r.matches) for r in table.audit().collect()} == {
        ("load", 10, 10, True), ("s", 6, 6, True)
    }
    first = table.parts()[0]["path"].removeprefix("file:")
    file = next(f for f in sorted(os.listdir(first)) if f.startswith("part-"))
    table.snapshots.delete(f"{first}/{file}")
    got = {r.stream: r for r in table.audit().collect()}
    assert got["load"].stored == 5 and got["load"].matches is False and got["s"].matches is True
    table.snapshots.delete(table.parts()[1]["path"])
    assert {r.stream: r.stored for r in table.audit().collect()} == {"load": 5, "s": 0}


def test_an_empty_table_and_an_empty_batch(spark, fresh):
    table = AppendTable(spark, fresh("table"))
    assert table.read().collect() == [] and table.audit().collect() == []
    table.append(spark.createDataFrame([], "a int"), "s", 0)
    assert table.read().columns == ["a"] and table.read().collect() == []


def test_stream_equals_batch(spark, fresh, lookups, schema):
    rows = star.fact(spark, SMALL, *COLUMNS)
    topic = messages.publish_files(rows, fresh("topic"))
    table = fresh("table")
    run(spark, lookups, schema, topic, table, fresh("progress"), fresh("bad"))
    streamed = jobs.read_appended(spark, table).select(COLUMNS)
    batch = encode.encode(rows, lookups, null_code=encode.UNSEEN).select(COLUMNS)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_messages_hold_null_and_text_times(spark):
    frame = spark.range(1).select(
        F.lit(float("nan")).alias("x"), F.lit(None).cast("string").alias("s"),
        F.lit("2024-01-02 03:04:05").cast("timestamp_ntz").alias("t"),
    )
    value = messages.to_messages(frame).first().value
    assert json.loads(value) == {"x": None, "s": None, "t": "2024-01-02 03:04:05"}


def hours(spark, fresh, batches, delay, restart=True):
    """Counts by the monitor and by one batch, and the sizes of its state; a new query per batch."""
    path, progress, folder = fresh("hours"), fresh("progress"), fresh("events")
    states = []
    for times in batches:
        spark.createDataFrame([(t, "k") for t in times], "ts string, kind string").select(
            F.col("ts").cast("timestamp").alias("ts"), "kind"
        ).coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema("ts timestamp, kind string").parquet(folder)
        jobs.finish([jobs.count_hours(source, path, progress, "ts", "kind", delay=delay)])
        kept = jobs.monitor(spark, path)
        states.append((spark.read.parquet(kept["state"]).where(F.col(kept["kind"]) == "open").count() if kept else 0, len(kept["done"])))
    got = {(str(r.hour), r.trades) for r in jobs.all_counts(spark, path).collect()}
    want = {(str(r.hour), r.trades) for r in jobs.hourly_counts(spark.read.parquet(folder)).collect()}
    return got, want, states


def test_hours_out_of_order_and_late(spark, fresh):
    batches = [
        ["2024-01-01 10:10:00", "2024-01-01 10:50:00", "2024-01-01 11:05:00"],
        ["2024-01-01 11:15:00", "2024-01-01 15:00:00", "2024-01-01 10:01:00"],
        ["2023-12-31 10:30:00", None, "2024-01-01 14:30:00"],  # a day late, unknown, within the delay
        ["2024-01-01 10:00:00", "2024-02-01 00:00:00"],
        ["2024-01-01 10:00:01", "2024-01-31 23:10:00"],
    ]
    got, want, _ = hours(spark, fresh, batches, dt.timedelta(hours=2))
    assert got == want


def test_the_state_of_the_monitor_is_bounded(spark, fresh, monkeypatch):
    """One hour a batch, out of order by pairs: the state holds the delay's hours, folders are gathered."""
    monkeypatch.setattr(jobs, "GATHER", 4)
    start = dt.datetime(2024, 1, 1)
    order = [i ^ 1 for i in range(14)]
    batches = [[str(start + dt.timedelta(hours=h, minutes=5)), str(start + dt.timedelta(hours=h, minutes=55))] for h in order]
    got, want, states = hours(spark, fresh, batches, dt.timedelta(hours=2))
    assert got == want
    assert max(n for n, _ in states) <= 4 and max(f for _, f in states) <= 4


def test_a_killed_batch_of_the_monitor_counts_once(spark, fresh, monkeypatch):
    path, progress, folder = fresh("hours"), fresh("progress"), fresh("events")
    spark.range(100).select((F.col("id") * 600).cast("timestamp").alias("ts")).write.parquet(folder)
    source = spark.readStream.schema("ts timestamp").parquet(folder)
    put = Snapshots.put

    def killed(self, snapshot):
        raise RuntimeError("killed")

    monkeypatch.setattr(Snapshots, "put", killed)
    with pytest.raises(Exception, match="killed"):
        jobs.finish([jobs.count_hours(source, path, progress)])
    monkeypatch.setattr(Snapshots, "put", put)
    for _ in range(2):
        jobs.finish([jobs.count_hours(source, path, progress)])
    assert jobs.all_counts(spark, path).agg(F.sum("trades")).first()[0] == 100
