"""Documents dealt into shards of near equal bytes, equal texts together.

Longest processing time first: groups of equal texts, from the largest down, go
to the shard with the least bytes, kept in a heap. The heap never sees single
small groups. It deals runs of groups of one size: every group above a share of
the total by itself, then bins of nearly equal sizes, then each of the sizes
below ``EXACT_SIZES`` exactly, starting from the bytes that really lie in the
shards by then. Runs, shards and large groups are bounded numbers, however many
documents there are; groups and documents are numbered and placed on the executors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import staged, whole_row, with_results
from marketloom.llm.shipping import ship_code

#: Sizes below this make a run each.
EXACT_SIZES = 1 << 13
#: Larger sizes share a run with those at most a part in this many (of a doubling) apart.
BINS_PER_DOUBLING = 128
#: Groups over the total / (shards * this) are dealt one by one.
LARGE_PER_SHARD = 64
OVERHEAD = 16
BUCKET_ROWS = 100_000


def balanced_shards(
    df: DataFrame, shards: int, text: str = "text", key: str = "doc_id", carry: list[str] | None = None
) -> DataFrame:
    """Every row of ``df`` with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``.

    ``size`` is the text's UTF-8 bytes and ``OVERHEAD``; NULL counts as empty and
    shares the empty text's group. ``shard`` runs from 0; ``slot`` numbers the
    rows of a shard from 0 without gaps. The law is ``bytes``: shards differ by
    about the smallest groups, unless a single group outweighs a shard.
    ``grown_shard`` is NULL, as another number of shards deals anew. ``carry``
    names the input columns to return (all by default); a result replaces an
    input column of its name. Repeated rows share a group; an empty table gives
    no rows.
    """
    names = df.columns if carry is None else carry
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = staged(
        df.select(
            whole_row(df, names).alias("row"),
            (F.octet_length(whole) + OVERHEAD).cast("long").alias("size"),
            F.crc32(F.encode(whole, "UTF-8")).alias("crc"),
            F.sha2(whole, 256).alias("sha"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("sha").agg(F.sum("size").alias("bytes"))
    placed = place_groups(groups, shards)
    task = F.shiftrightunsigned("uid", 33)
    dealt = staged(
        rows.join(placed, "sha").select("row", "size", "crc", "uid", "shard", task.alias("bucket")), "shard-dealt"
    )
    numbered = _numbered(dealt, "shard", "uid", "slot")
    results = {
        "size": F.col("size"),
        "text_crc32": F.col("crc"),
        "law": F.lit("bytes"),
        "shard": F.col("shard"),
        "slot": F.col("slot"),
        "grown_shard": F.lit(None).cast("int"),
    }
    return with_results(numbered, names, results)


def write_shards(placed: DataFrame, path: str, files: int) -> None:
    """One folder a shard, its rows in order of ``slot`` over about ``files`` files in all."""
    ordered = placed.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)


def place_groups(groups: DataFrame, shards: int) -> DataFrame:
    """``sha, shard`` for groups ``sha, bytes``, longest first onto the least loaded shard."""
    groups = staged(groups, "shard-groups")
    total, count = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1))).first()
    large = max(total // (shards * LARGE_PER_SHARD), EXACT_SIZES)
    binned = groups.select(
        "sha",
        "bytes",
        _run(F.col("bytes"), large).alias("run"),
        F.pmod(F.xxhash64("sha"), F.lit(max(1, ceil(count / BUCKET_ROWS)))).alias("bucket"),
    )
    ranked = staged(_numbered(binned, "run", "sha", "rank"), "shard-ranked")
    runs = {
        row["run"]: (row["n"], row["bytes"] / row["n"])  # EXACT_SIZES, bins and large groups: a bounded number
        for row in ranked.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).collect()
    }
    single = ranked.where(F.col("run") == _large_run()).select("bytes", "rank").collect()
    loads = np.zeros(shards)
    deal_large, loads = _deal_large(single, loads)
    middle = {r: v for r, v in runs.items() if EXACT_SIZES <= r < _large_run()}
    deal_middle, loads = _deal_runs(middle, loads)
    upper = staged(
        _assigned(ranked.where(F.col("run") >= EXACT_SIZES), [*deal_large, *deal_middle]), "shard-upper"
    )
    real = np.zeros(shards)
    for row in upper.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect():
        real[row["shard"]] = row["bytes"]
    small = {r: v for r, v in runs.items() if r < EXACT_SIZES}
    deal_small, _ = _deal_runs(small, real)
    lower = _assigned(ranked.where(F.col("run") < EXACT_SIZES), deal_small)
    return staged(upper.unionAll(lower).select("sha", "shard"), "shard-placed")


def _large_run() -> int:
    """The run of large groups, above all bins of sizes that a long can hold."""
    return EXACT_SIZES + BINS_PER_DOUBLING * ceil(63 - log2(EXACT_SIZES))


def _run(size: Column, large: int) -> Column:
    bins = EXACT_SIZES + F.floor(F.log2(size / EXACT_SIZES) * BINS_PER_DOUBLING)
    return F.when(size < EXACT_SIZES, size).when(size > large, _large_run()).otherwise(bins).cast("long")


def _numbered(df: DataFrame, by: str, order: str, name: str) -> DataFrame:
    """Number the rows of each ``by`` from 0: within ``bucket``, then offset by the buckets before.

    A hot ``by`` is numbered by as many tasks as it has buckets.
    """
    sizes = staged(df.groupBy(by, "bucket").agg(F.count(F.lit(1)).alias("n")), "bucket-sizes")
    before = Window.partitionBy(by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(by, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy(by, "bucket").orderBy(order)) - 1
    return (
        df.withColumn("inside", inside)
        .join(bases, [by, "bucket"])
        .withColumn(name, F.col("base") + F.col("inside"))
        .drop("base", "inside", "bucket")
    )


def _deal_large(groups: list, loads: np.ndarray) -> tuple[list[tuple[int, int, int]], np.ndarray]:
    heap, dealt = [(load, shard) for shard, load in enumerate(loads)], []
    heapq.heapify(heap)
    for row in sorted(groups, key=lambda r: (-r["bytes"], r["rank"])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + row["bytes"], shard))
        dealt.append((_large_run(), row["rank"], shard))
    return dealt, np.array([load for load, _ in sorted(heap, key=lambda x: x[1])])


def _deal_runs(runs: dict, loads: np.ndarray) -> tuple[list[tuple[int, int, int]], np.ndarray]:
    """``(run, first rank, shard)`` for runs of equal groups, the largest size first; and the loads after it."""
    dealt, loads = [], loads.astype(float)
    for run in sorted(runs, reverse=True):
        n, size = runs[run]
        counts = deal(loads, n, size)
        first = 0
        for shard in np.flatnonzero(counts).tolist():
            dealt.append((run, first, shard))
            first += int(counts[shard])
        loads = loads + counts * size
    return dealt, loads


def deal(loads: np.ndarray, n: int, size: float) -> np.ndarray:
    """How many of ``n`` equal groups each shard gets when each goes to the least loaded one.

    All shards below the level that the groups would fill are raised to just
    under it at once; the heap deals the last few.
    """
    counts = np.zeros(len(loads), np.int64)
    spare = (n - len(loads)) * size
    if spare > 0:
        ordered = np.sort(loads)
        levels = (spare + np.cumsum(ordered)) / np.arange(1, len(loads) + 1)
        fits = levels <= np.append(ordered[1:], np.inf)
        counts = np.floor(np.maximum(0, levels[np.argmax(fits)] - loads) / size).astype(np.int64)
    heap = [(load, shard) for shard, load in enumerate((loads + counts * size).tolist())]
    heapq.heapify(heap)
    for _ in range(n - int(counts.sum())):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        counts[shard] += 1
    return counts


def _assigned(ranked: DataFrame, dealt: list[tuple[int, int, int]]) -> DataFrame:
    """``sha, bytes, shard``: the shard whose first rank is the last one not above the group's."""
    ship_code(ranked.sparkSession)
    table = np.array(sorted(dealt), np.int64).reshape(-1, 3)
    plan = ranked.sparkSession.sparkContext.broadcast(table)  # runs times shards, see the module's head
    schema = ranked.select("sha", "bytes", F.lit(0).alias("shard")).schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = plan.value[:, 0] << 44 | plan.value[:, 1]
        for batch in batches:
            run, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("run", "rank"))
            at = np.searchsorted(keys, run << 44 | rank, side="right") - 1
            shard = plan.value[at, 2].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("sha"), batch.column("bytes"), pa.array(shard)], schema.names)

    return ranked.select("sha", "bytes", "run", "rank").mapInArrow(rows, schema)
