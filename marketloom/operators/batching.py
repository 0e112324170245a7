"""Count windows: every N accepted rows in arrival order form a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.schema import BATCH_SIZE
from marketloom.session import staged

BUCKET_OFFSETS = 1 << 20
BUCKETS_PER_SPAN = 1 << 10
BATCHES_PER_SPAN = 1_000


def whole_division(value: Column, by: int) -> Column:
    """Integer division; exact where doubles are not."""
    return F.call_function("div", value.cast("long"), F.lit(by))


def bucket_bases(
    df: DataFrame, lead: Sequence[str], span_of: Column, bucket: str = "_bucket"
) -> DataFrame:
    """Rows that precede each bucket, as ``(*lead, bucket, _base, _total)``.

    Two levels keep every task small: buckets are summed inside a span, and only
    the span totals (one per about a billion offsets) meet in a single task.
    """
    counts = (
        df.groupBy(*lead, bucket)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_span", span_of)
    )
    # The joins imply this for one use of the counts; said for both, they share one shuffle.
    for key in (*lead, bucket, "_span"):
        counts = counts.filter(F.col(key).isNotNull())
    before = (Window.unboundedPreceding, -1)
    everything = (Window.unboundedPreceding, Window.unboundedFollowing)
    over_spans = Window.orderBy(*lead, "_span")
    spans = (
        counts.groupBy(*lead, "_span")
        .agg(F.sum("_rows").alias("_span_rows"))
        .withColumns(
            {
                "_span_base": F.coalesce(
                    F.sum("_span_rows").over(over_spans.rowsBetween(*before)), F.lit(0)
                ),
                "_total": F.sum("_span_rows").over(over_spans.rowsBetween(*everything)),
            }
        )
        .drop("_span_rows")
    )
    inside = Window.partitionBy(*lead, "_span").orderBy(bucket).rowsBetween(*before)
    return (
        counts.withColumn("_inside", F.coalesce(F.sum("_rows").over(inside), F.lit(0)))
        .join(spans, [*lead, "_span"])
        .select(*lead, bucket, (F.col("_span_base") + F.col("_inside")).alias("_base"), "_total")
    )


def number_rows(
    df: DataFrame,
    lead: Sequence[str],
    bucket: Column,
    order_by: Sequence[Column | str],
    span_of: Column | None = None,
) -> DataFrame:
    """Add ``row_no``, the 1-based global position, and ``total_rows``, without a global sort.

    Buckets must follow the wanted order and hold a bounded number of rows each.
    The ranking and the join with the bases share one hash partitioning, so the
    rows are shuffled once; the bases are broadcast only if their measured size
    allows it.
    """
    keyed = df.withColumn("_bucket", bucket)
    span_of = F.lit(0) if span_of is None else span_of
    bases = bucket_bases(keyed, lead, span_of)
    inside = Window.partitionBy(*lead, "_bucket").orderBy(*order_by)
    return (
        keyed.withColumn("_place", F.row_number().over(inside))
        .join(bases, [*lead, "_bucket"])
        .withColumn("row_no", F.col("_base") + F.col("_place"))
        .withColumnRenamed("_total", "total_rows")
        .drop("_bucket", "_place", "_base")
    )


def number_in_order(
    df: DataFrame, order: Sequence[str], batch_size: int = BATCH_SIZE, start: int = 0
) -> tuple[DataFrame, int]:
    """``df`` with ``row_no`` and ``batch_no`` by the order of any unique columns, and how many rows there are.

    Rows are shuffled once, into sorted ranges that sampling makes even, and
    staged with their place in the range; only the sizes of the ranges are added
    up, a row a task.
    """
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(
        ranges.select(
            "*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_seq")
        ),
        "numbered",
    )
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"), F.min("_seq").alias("_first"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_range", "_rows", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    bases = staged(bases, "ranges")
    total = bases.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    row_no = F.col("_base") + F.col("_seq") - F.col("_first") + 1 + F.lit(start)
    numbered = placed.join(bases, "_range").withColumn("row_no", row_no)
    return (
        numbered.withColumn("batch_no", batch_number(F.col("row_no"), batch_size)).drop(
            "_range", "_seq", "_first", "_base", "_rows"
        ),
        total,
    )


def number_batches(
    df: DataFrame,
    batch_size: int = BATCH_SIZE,
    *,
    partition: str | None = "partition",
    offset: str = "offset",
    start: int = 0,
    mark_remainder: bool = False,
    bucket_offsets: int = BUCKET_OFFSETS,
) -> DataFrame:
    """Add ``row_no`` and ``batch_no`` (from 1) in ``(partition, offset)`` order.

    ``start`` is the number of rows numbered earlier. ``mark_remainder`` adds
    ``is_remainder`` for the last batch if these rows do not fill it. Offsets are unique within
    a partition, so a bucket never holds more than ``bucket_offsets`` rows,
    whatever the skew between topic partitions.
    """
    numbered = number_rows(
        df,
        [partition] if partition else [],
        whole_division(F.col(offset), bucket_offsets),
        [offset],
        whole_division(F.col("_bucket"), BUCKETS_PER_SPAN),
    )
    numbered = numbered.withColumn("row_no", F.col("row_no") + F.lit(start))
    batch_no = batch_number(F.col("row_no"), batch_size)
    if mark_remainder:
        last = is_remainder(batch_no, F.col("total_rows") + F.lit(start), batch_size)
        numbered = numbered.withColumn("is_remainder", last)
    return numbered.withColumn("batch_no", batch_no).drop("total_rows")


def batch_number(row_no: Column, batch_size: int) -> Column:
    return whole_division(row_no - 1, batch_size) + 1


def is_remainder(batch_no: Column, total_rows: Column | int, batch_size: int = BATCH_SIZE) -> Column:
    """Whether a batch is the last, partly filled one; ``total_rows`` is all rows numbered."""
    total = total_rows if isinstance(total_rows, Column) else F.lit(total_rows)
    return batch_no > whole_division(total, batch_size)


def batch_span(batch_no: Column) -> Column:
    """Directory key of a batch, so that a store of millions of batches stays listable."""
    return whole_division(batch_no - 1, BATCHES_PER_SPAN)
