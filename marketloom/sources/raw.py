"""Raw CSV datasets as rows with a place of their own, read by Spark's CSV reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.functions.csvtext import csv_record
from marketloom.schema import CSV_READ_OPTIONS, WIRE_FIELD_COUNT


def read_rows(
    spark: SparkSession, path: str, arity: int = WIRE_FIELD_COUNT, multiline: bool = True
) -> DataFrame:
    """Rows of CSV files as ``(file_path, position, fields)``, the header of each file left out.

    ``position`` rises with the place in the file and is unique in it: the start
    of the row's split plus its rank there, as a split holds fewer rows than bytes.
    The rank is the row's running number less the least one of its split, which a
    small grouped table gives; rows are neither shuffled nor sorted for it.

    With ``multiline`` fields may hold line breaks, and a file is one task; many
    files make many tasks. Without it every line is a row, and large files are
    split. Blank lines vanish, and stray quotes may split differently from the
    wire's dialect. Rows of another length keep their own fields, to be rejected
    downstream.
    """
    columns = [f"c{i}" for i in range(arity)]
    schema = ", ".join(f"{c} string" for c in [*columns, "_odd"])
    rows = (
        spark.read.schema(schema)
        .options(**{**CSV_READ_OPTIONS, "multiLine": multiline})
        .option("columnNameOfCorruptRecord", "_odd")
        .csv(path)
    )
    own = csv_record(F.col("_odd"))["fields"]
    fields = F.array(*[F.coalesce(c, F.lit("")) for c in columns])
    placed = rows.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
        F.when(F.col("_odd").isNull(), fields).otherwise(own).alias("fields"),
    )
    # A split is read by one task, so its running numbers follow each other; both reads deal the splits alike.
    least = placed.groupBy("file_path", "_block").agg(F.min("_seq").alias("_first"))
    ranked = placed.join(least, ["file_path", "_block"])
    return ranked.select("file_path", (F.col("_block") + F.col("_seq") - F.col("_first")).alias("position"), "fields")


def file_ranks(spark: SparkSession, path: str) -> DataFrame:
    """``(file_path, file_rank)``, from 0 in the order of the names; contents are not read.

    One row a file meets in a single task.
    """
    files = spark.read.format("binaryFile").load(path).select("_metadata.file_path").distinct()
    rank = F.row_number().over(Window.orderBy("file_path")) - 1
    return files.select("file_path", rank.cast("int").alias("file_rank"))
