"""Batch counterparts of the stream: publish a dataset, and take in a whole topic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import csv_line_of
from marketloom.schema import BATCH_SIZE, WIRE_FIELD_COUNT
from marketloom.sources.raw import file_ranks, read_rows
from marketloom.sources.topic import as_messages, write_topic
from marketloom.streaming.ingest import IngestStore, ingest_micro_batch


def dataset_messages(
    spark: SparkSession,
    path: str,
    topic: str,
    multiline: bool = True,
    arity: int = WIRE_FIELD_COUNT,
) -> DataFrame:
    """One message per record of a CSV dataset, headers left out, fields re-encoded.

    Files follow each other by name: a file's rank is the partition of its
    messages, and the place of a record in its file the offset, so no two
    messages share both. See ``read_rows`` for ``multiline``.
    """
    rows = read_rows(spark, path, arity, multiline).join(file_ranks(spark, path), "file_path")
    value = F.encode(csv_line_of(F.col("fields")), "UTF-8").alias("value")
    return as_messages(rows.select("file_rank", "position", value), topic, "position", "file_rank")


def publish_dataset(
    spark: SparkSession,
    path: str,
    topic: str,
    topic_path: str | None = None,
    kafka: Mapping[str, str] | None = None,
    multiline: bool = True,
    partitions: int = 1,
) -> None:
    messages = dataset_messages(spark, path, topic, multiline)
    options = None if kafka is None else {"topic": topic, **kafka}
    write_topic(messages, topic_path, options, partitions=partitions)


def ingest_topic(
    messages: DataFrame, base: str, batch_size: int = BATCH_SIZE, **settings
) -> IngestStore:
    """A whole topic as a single micro-batch: the rows a stream takes in if messages arrive in time order."""
    store = IngestStore(base)
    store.write_settings(messages.sparkSession, batch_size, settings.get("positions"))
    ingest_micro_batch(messages, 0, store, batch_size, **settings)
    return store
