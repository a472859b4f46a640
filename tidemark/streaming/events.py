"""Event sources: raw messages in, typed rows with a watermark out.

Every source yields (topic, value, broker_ts); the parser does not care whether
Kafka or a folder of JSON lines is behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def subscribe(
    spark: SparkSession,
    topics: list[str],
    servers: str,
    starting: str = "latest",
    max_offsets: int | None = None,
    source: str = "kafka",
) -> DataFrame:
    """Messages of the topics; lost offsets are tolerated.  Needs the Kafka package."""
    reader = (
        spark.readStream.format(source)
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .option("failOnDataLoss", "false")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        "topic", F.col("value").cast("string").alias("value"), F.col("timestamp").alias("broker_ts")
    )


def json_folder(
    spark: SparkSession, folder: str, topic: str, max_files: int | None = None
) -> DataFrame:
    """The same contract over text files with one JSON message per line."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select(
        F.lit(topic).alias("topic"),
        "value",
        F.col("_metadata.file_modification_time").alias("broker_ts"),
    )


def parse_events(raw: DataFrame, schema: str, delay: str = "2 minutes") -> DataFrame:
    """Typed events with ``event_time`` and a watermark.

    A malformed message becomes a row of nulls and an unreadable time a null;
    the validity filters of the window functions drop both.
    """
    return (
        raw.select(F.from_json("value", schema).alias("event"), "broker_ts")
        .select("event.*", "broker_ts")
        .withColumn("event_time", F.try_to_timestamp("timestamp"))
        .withWatermark("event_time", delay)
    )
