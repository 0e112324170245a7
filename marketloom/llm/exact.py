"""Exact duplicates by two passes over a blocked Bloom filter.

Pass one sets two bits for every text and keeps those bits that were set more
than once. Pass two looks each text up in that filter: a text with both bits
set may have a copy, any other has none. Only the former are shuffled; the
latter go straight to the output, where they were read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import blank_free, staged, whole_row, with_results

BLOCK_BITS = 512
BITS_PER_KEY = 16
WORD = 64


def exact_duplicates(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    carry: list[str] | None = None,
    round_keys: int = 1 << 24,
    write_hashes: bool = False,
) -> DataFrame:
    """Every row of ``df`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they agree after all ASCII white space is deleted; NULL
    counts as empty, so it equals a blank text. Of equal texts the one with the
    most code points stays, then the smallest key, a NULL key last; of rows that
    tie in that too exactly one stays. ``carry`` names the input columns to
    return (all by default); a result replaces an input column of its name.
    An empty table gives no rows.

    ``round_keys`` bounds the filter that is broadcast, at about four bytes a
    key. More rows are worked off in rounds by hash range, each with a filter of
    its own; the rows are then first written out by round, so each is read once.
    ``write_hashes`` writes rows and hashes out in any case, so that each text is
    normalised and hashed once and not for each pass: for columns to carry that are
    small beside the text.
    """
    names = df.columns if carry is None else carry
    keys = max(df.count(), 1)
    rounds = -(-keys // round_keys)
    n_blocks = -(-keys * BITS_PER_KEY // (rounds * BLOCK_BITS))
    normal = blank_free(F.col(text))
    rows = df.select(
        whole_row(df, names).alias("row"),
        F.col(key).alias("id"),
        F.length(F.coalesce(F.col(text), F.lit(""))).alias("chars"),
        F.sha2(normal, 256).alias("sha"),
        F.xxhash64(normal).alias("hash"),
    ).withColumn("round", F.pmod(F.xxhash64("hash"), F.lit(rounds)))
    if rounds > 1:
        rows = staged(rows, "dedup-rounds", partition_by=["round"])
    elif write_hashes:
        rows = staged(rows, "dedup-hashes")
    parts = [_one_round(rows.where(F.col("round") == r), n_blocks) for r in range(rounds)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    results = {name: F.col(f"found.{name}") for name in ("keep_id", "group_size", "kept", "text_sha256")}
    return with_results(found, names, results)


def _one_round(rows: DataFrame, n_blocks: int) -> DataFrame:
    block = F.pmod(F.shiftrightunsigned("hash", 18), F.lit(n_blocks)).alias("block")
    rows = rows.select("*", block, *_probes())
    repeated = staged(_repeated_bits(rows), "dedup-filter")
    # The filter has n_blocks rows of eight numbers at most, whatever the input.
    looked = rows.join(F.broadcast(repeated), "block", "left").select(
        "row", "id", "chars", "sha", F.coalesce(_both_set(), F.lit(False)).alias("suspect")
    )
    single = looked.where(~F.col("suspect")).select(
        "row",
        F.struct(
            F.col("id").alias("keep_id"),
            F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"),
            F.col("sha").alias("text_sha256"),
        ).alias("found"),
    )
    suspects = staged(
        looked.where("suspect").select(
            "row", "id", "chars", "sha", F.monotonically_increasing_id().alias("uid")
        ),
        "dedup-suspects",
    )
    order = F.struct((-F.col("chars")).alias("c"), F.col("id").isNull().alias("n"), "id", "uid")
    # Written out, so that the join below may split a hot text on either side.
    groups = staged(
        suspects.groupBy("sha").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("size")),
        "dedup-groups",
    )
    resolved = suspects.join(groups, "sha").select(
        "row",
        F.struct(
            F.col("best.id").alias("keep_id"),
            F.col("size").alias("group_size"),
            (F.col("uid") == F.col("best.uid")).alias("kept"),
            F.col("sha").alias("text_sha256"),
        ).alias("found"),
    )
    return single.unionAll(resolved)


def _probes() -> list[Column]:
    """One bit in each half of the block, from hash bits that do not choose the block."""
    half = BLOCK_BITS // 2
    return [
        F.col("hash").bitwiseAND(half - 1).cast("int").alias("probe_a"),
        (F.shiftrightunsigned("hash", 8).bitwiseAND(half - 1) + half).cast("int").alias("probe_b"),
    ]


def _repeated_bits(rows: DataFrame) -> DataFrame:
    """Blocks as eight 64-bit words, with the bits that more than one row sets.

    Only bit numbers are shuffled here, counted beforehand in each task.
    """
    bit = F.explode(F.array("probe_a", "probe_b")).alias("bit")
    repeated = (
        rows.select("block", bit).groupBy("block", "bit").count().where(F.col("count") > 1)
    )
    words = [
        F.bit_or(
            F.when(F.expr(f"bit div {WORD} = {w}"), F.expr(f"shiftleft(1L, bit % {WORD})")).otherwise(
                F.lit(0).cast("long")
            )
        ).alias(f"w{w}")
        for w in range(BLOCK_BITS // WORD)
    ]
    return repeated.groupBy("block").agg(*words).select(
        "block", F.array(*[f"w{w}" for w in range(BLOCK_BITS // WORD)]).alias("words")
    )


def _both_set() -> Column:
    def is_set(probe: str) -> Column:
        return F.expr(f"getbit(words[{probe} div {WORD}], {probe} % {WORD}) = 1")

    return is_set("probe_a") & is_set("probe_b")
