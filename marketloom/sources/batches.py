"""Batches on storage: CSV files per batch, and a parquet store of all batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.operators.batching import batch_span
from marketloom.operators.snapshots import batch_file_name, parse_batch_names
from marketloom.schema import BATCH_COLUMNS, BATCH_SCHEMA, CSV_READ_OPTIONS, CSV_WRITE_OPTIONS

FILE_KEY = "batch_file"
SPAN_KEY = "batch_span"
#: Readers of the batch files pass over folders that begin like this.
EXPORTED = "_exported"


def _file_name(path: Column) -> Column:
    """A batch is one file, or one directory ``batch_file=<name>`` of part files."""
    directory = F.regexp_extract(path, rf"/{FILE_KEY}=([^/]+)/", 1)
    return F.coalesce(F.nullif(directory, F.lit("")), F.element_at(F.split(path, "/"), -1))


def write_batch_files(
    numbered: DataFrame, path: str, written: Column, remaining: Column, only_these: bool = False
) -> None:
    """One CSV file with header per batch, in ``batch_span=<s>/batch_file=batch_<n>_<time>[_remaining].csv/``.

    The first level holds a thousand batches, so that millions stay listable.
    With ``only_these`` other batches at ``path`` stay, and a file of the same name
    is replaced; else everything there is.
    """
    named = numbered.withColumns(
        {
            SPAN_KEY: batch_span(F.col("batch_no")),
            FILE_KEY: batch_file_name(F.col("batch_no"), written, remaining),
        }
    )
    (
        named.repartition("batch_no")
        .sortWithinPartitions("batch_no", "row_no")
        .select(*[f"`{c}`" for c in BATCH_COLUMNS], SPAN_KEY, FILE_KEY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only_these else "static")
        .partitionBy(SPAN_KEY, FILE_KEY)
        .options(**CSV_WRITE_OPTIONS)
        .csv(path)
    )


def list_batch_files(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ``file_name`` of the CSV batches below ``path``; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(path)
    )
    return files.select(_file_name(F.col("path")).alias("file_name")).distinct()


def _unless_absent(read: Callable[[], DataFrame], absent: DataFrame) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return absent


def exported_batches(spark: SparkSession, path: str) -> DataFrame:
    """``batch_no`` of the batches whose export was committed and whose file is there.

    A file without a commit may be of an export that broke off, and a commit
    without a file of one that was lost since.
    """
    none = spark.createDataFrame([], "batch_no long")
    committed = _unless_absent(lambda: spark.read.schema("batch_no long").parquet(f"{path}/{EXPORTED}"), none)
    there = _unless_absent(lambda: parse_batch_names(list_batch_files(spark, path)).select("batch_no"), none)
    return committed.distinct().join(there, "batch_no", "left_semi")


def commit_exported(exported: DataFrame, path: str) -> None:
    """Say that the batches in ``batch_no`` are at ``path``, with their ``rows``; appended as one job."""
    exported.select("batch_no", "rows").write.mode("append").parquet(f"{path}/{EXPORTED}")


def read_batch_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All rows of the CSV batches below ``path`` with their ``file_name``.

    A batch file holds a bounded number of rows, so reading whole files (fields
    may contain newlines) keeps tasks small. Empty text is a missing value.
    """
    rows = (
        spark.read.schema(BATCH_SCHEMA)
        .options(**CSV_READ_OPTIONS)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .csv(path)
    )
    return rows.select(
        *[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in BATCH_COLUMNS],
        _file_name(F.col("_metadata.file_path")).alias("file_name"),
    )


def write_batch_store(numbered: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet, in one directory per thousand batches, ordered so that footers prune batches."""
    (
        numbered.withColumn(SPAN_KEY, batch_span(F.col("batch_no")))
        .sortWithinPartitions("batch_span", "row_no")
        .write.mode(mode)
        .partitionBy(SPAN_KEY)
        .parquet(path)
    )


def read_batch_store(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Rows with ``row_no`` and ``batch_no``; see ``up_to_batch`` for pruned reads."""
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def up_to_batch(store: DataFrame, last: int) -> DataFrame:
    """The first batches only: prunes directories by span and row groups by number."""
    return store.filter(
        (F.col("batch_span") <= batch_span(F.lit(last))) & (F.col("batch_no") <= last)
    )
