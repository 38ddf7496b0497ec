"""Trades as JSON messages: publish, subscribe, parse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.sources import kafka

# Fixed spellings of the end-of-stream message.
END_OF_STREAM = ['"EOS"', "EOS", '{"message":"EOS"}', '{"message": "EOS"}']


def to_messages(frame: DataFrame) -> DataFrame:
    """One JSON object per row in `value`; NULL and NaN become null, times become text."""
    plain = []
    for f in frame.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        plain.append(c.alias(f.name))
    row = F.to_json(F.struct(*plain), {"ignoreNullFields": "false"})
    return frame.select(row.alias("value"))


def publish_files(frame: DataFrame, path: str) -> str:
    """Write the messages as lines and, behind them, the end-of-stream line."""
    to_messages(frame).write.mode("append").text(path)
    end = frame.sparkSession.range(1, numPartitions=1).select(F.lit(END_OF_STREAM[0]).alias("value"))
    end.write.mode("append").text(path)
    return path


def publish_kafka(frame: DataFrame, servers: str, topic: str) -> None:
    options = kafka.sink_options(servers, topic)
    to_messages(frame).write.format("kafka").options(**options).save()
    end = frame.sparkSession.range(1, numPartitions=1).select(F.lit(END_OF_STREAM[0]).alias("value"))
    end.write.format("kafka").options(**options).save()


def subscribe_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of `value` from lines of text; the pace is a number of files per batch."""
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def subscribe_kafka(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None) -> DataFrame:
    options = kafka.source_options(servers, topic, max_offsets)
    source = spark.readStream.format("kafka").options(**options).load()
    return source.select(F.col("value").cast("string").alias("value"))


def without_end(messages: DataFrame) -> DataFrame:
    return messages.filter(~F.trim("value").isin(END_OF_STREAM))


def parse(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Adds `record`, and `broken` for messages that are no object of that schema."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    widened = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = without_end(messages).withColumn("_parsed", F.from_json("value", widened, options))
    broken = F.col("_parsed").isNull() | F.col("_parsed._corrupt").isNotNull()
    record = F.struct(*[F.col(f"_parsed.`{f.name}`").alias(f.name) for f in schema.fields])
    return parsed.select("value", record.alias("record"), F.coalesce(broken, F.lit(True)).alias("broken"))
