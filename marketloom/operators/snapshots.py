"""Batch order and the three cumulative snapshots: first batch, first two, all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.operators.batching import number_rows, whole_division
from marketloom.schema import SNAPSHOTS

_NAME = r"^batch_(\d+)_(\d+)(_remaining)?\.csv$"


def batch_file_name(number: Column, written: Column, remaining: Column | None = None) -> Column:
    """``batch_<n>_<yyyyMMddHHmmss>.csv``, with ``_remaining`` for a partial batch."""
    stamp = F.date_format(written, "yyyyMMddHHmmss")
    suffix = F.lit("") if remaining is None else F.when(remaining, "_remaining").otherwise("")
    return F.format_string("batch_%d_%s%s.csv", number, stamp, suffix)


def parse_batch_names(df: DataFrame, name: str = "file_name") -> DataFrame:
    return df.withColumns(
        {
            "batch_no": F.regexp_extract(name, _NAME, 1).try_cast("long"),
            "written": F.regexp_extract(name, _NAME, 2),
            "is_remainder": F.regexp_extract(name, _NAME, 3) != "",
        }
    )


def batch_order(order: str = "numeric", name: str = "file_name") -> list[Column]:
    """Sort keys: by number and time, or by the plain text of the name."""
    if order == "numeric":
        return [F.col("batch_no").asc_nulls_last(), F.col("written").asc(), F.col(name).asc()]
    if order == "lexical":
        return [F.col(name).asc()]
    raise ValueError(f"unknown batch order: {order}")


def rank_batches(names: DataFrame, order: str = "numeric", name: str = "file_name") -> DataFrame:
    """Add ``batch_rank`` (from 1) to distinct batch file names.

    Buckets follow the order: thousands of batch numbers, or the first characters
    of the name (``batch_`` and up to four more), so no task sees all names.
    """
    parsed = parse_batch_names(names, name)
    if order == "numeric":
        bucket = F.coalesce(whole_division(F.col("batch_no"), 1_000), F.lit((1 << 63) - 1))
        span = whole_division(F.col("_bucket"), 1_000)
    else:
        bucket, span = F.substring(name, 1, 10), F.substring(F.col("_bucket"), 1, 8)
    ranked = number_rows(parsed, [], bucket, batch_order(order, name), span)
    return ranked.withColumnRenamed("row_no", "batch_rank").drop("total_rows")


def first_batches(names: DataFrame, order: str = "numeric", name: str = "file_name") -> list[str]:
    """The first three names: the two that split the snapshots, and proof of a third.

    A top-k, not a sort: each task keeps three names.
    """
    rows = parse_batch_names(names, name).orderBy(*batch_order(order, name)).limit(3)
    return [r[name] for r in rows.select(name).collect()]


def tier_of_rank(rank: Column) -> Column:
    """The first snapshot that holds a batch: 1, 2 or 3. Snapshot s is ``tier <= s``."""
    return F.least(rank, F.lit(len(SNAPSHOTS))).cast("int")


def tier_of_name(name: Column, first_names: list[str]) -> Column:
    return (
        F.when(name == first_names[0], 1).when(name == first_names[1], 2).otherwise(3).cast("int")
    )


def snapshot(df: DataFrame, which: str, tier: str = "tier") -> DataFrame:
    """Rows of one snapshot; on a table partitioned by tier this prunes directories."""
    return df.filter(F.col(tier) <= SNAPSHOTS.index(which) + 1)


def cumulative_snapshots(df: DataFrame, tier: str = "tier") -> DataFrame:
    """All snapshots at once: a bag union with at most three copies of a row."""
    names = F.array(*[F.lit(s) for s in SNAPSHOTS])
    held = F.slice(names, F.col(tier), F.lit(len(SNAPSHOTS)))
    return df.withColumn("snapshot", F.explode(held)).drop(tier)
