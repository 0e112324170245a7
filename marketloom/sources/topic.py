"""Topics: Kafka, or a directory of parquet files with the same columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.schema import TOPIC_SCHEMA


def _kafka(reader, options: Mapping[str, str], min_partitions: int | None):
    """A topic partition may hold most messages; ``min_partitions`` splits its offsets over tasks."""
    reader = reader.format("kafka").option("startingOffsets", "earliest")
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return reader.options(**options)


def read_topic(
    spark: SparkSession,
    path: str | None = None,
    kafka: Mapping[str, str] | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """All messages so far, as a batch."""
    if kafka is not None:
        return _kafka(spark.read, kafka, min_partitions).load()
    return spark.read.schema(TOPIC_SCHEMA).parquet(path)


def stream_topic(
    spark: SparkSession,
    path: str | None = None,
    kafka: Mapping[str, str] | None = None,
    per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Messages as a stream, from the earliest offset unless a checkpoint knows better.

    ``per_trigger`` bounds a micro-batch: offsets for Kafka, files for a directory
    (whose files must then arrive in offset order).
    """
    if kafka is not None:
        reader = _kafka(spark.readStream, kafka, min_partitions)
        if per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", per_trigger)
        return reader.load()
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(path)


def as_messages(
    df: DataFrame,
    topic: str,
    offset: str,
    partition: str | None = None,
    timestamp: str | None = None,
) -> DataFrame:
    """Topic-shaped rows from a ``value`` column, without keys.

    ``offset`` must be unique within ``partition`` (one partition by default);
    without a ``timestamp`` all messages arrive now.
    """
    place = F.col(partition) if partition else F.lit(0)
    arrival = F.col(timestamp).cast("timestamp") if timestamp else F.current_timestamp()
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value"),
        F.lit(topic).alias("topic"),
        place.cast("int").alias("partition"),
        F.col(offset).cast("long").alias("offset"),
        arrival.alias("timestamp"),
    )


def in_publish_order(messages: DataFrame, partitions: int = 1) -> DataFrame:
    """``(value, partition)`` rows for a topic of so many partitions, each written by one task in order.

    Source partitions are dealt to topic partitions by their number.
    """
    target = F.pmod("partition", F.lit(partitions)).cast("int").alias("target")
    dealt = messages.select(target, "value", "partition", "offset").repartition("target")
    ordered = dealt.sortWithinPartitions("target", "partition", "offset")
    return ordered.select("value", F.col("target").alias("partition"))


def write_topic(
    messages: DataFrame,
    path: str | None = None,
    kafka: Mapping[str, str] | None = None,
    mode: str = "append",
    partitions: int = 1,
) -> None:
    """Publish messages; Kafka assigns offsets itself, in the order of ``in_publish_order``."""
    if kafka is not None:
        in_publish_order(messages, partitions).write.format("kafka").options(**kafka).save()
    else:
        messages.write.mode(mode).parquet(path)
