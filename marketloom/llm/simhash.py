"""Near duplicates by SimHash fingerprints that differ in a few bits.

Links are searched in the space of bit counts. A fingerprint is cut into 32
segments of two bits and mapped to the number of bits set in each, a point on
a grid. Two fingerprints differ in at least as many bits as their points are
apart in Manhattan distance, so points farther apart than the limit need no
look at their bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import staged, whole_row, with_results
from marketloom.llm.graph import components
from marketloom.llm.shipping import ship_code

SEGMENTS = 32
LOW_BITS = 0x5555555555555555
#: Entropy of the bits set in a two-bit segment of random bits.
SEGMENT_ENTROPY = 1.5
#: Fingerprints of a grid cell up to which all of them are compared.
SMALL_CELL = 100
#: Pairs of a larger cell beyond which it is split by the bits themselves, and the bits' groups there.
DENSE_PAIRS = 1_000_000
BIT_GROUPS = 8


def simhash(text: str, words: int = 4, seed: int = 42) -> int:
    """Fingerprint of a text as a signed 64-bit number.

    A-Z is lower-cased; words are runs of anything but ASCII white space. Every
    run of ``words`` words is hashed by XXH64, repeats included; fewer words make
    one run. A bit is set where more than half of the hashes set it. No word: 0.
    """
    parts = text.encode().lower().split()
    if not parts:
        return 0
    joined, n = b" ".join(parts), len(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, n) + 1)
    starts = [0, *ends.tolist()]
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(joined[a : z - 1], seed) for a, z in zip(starts, starts[min(words, n) :], strict=False)),
        ">u8",
    )
    often = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a bounded bit table for any length
        often += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * often > len(hashes)).view(">i8")[0])


def fingerprints(df: DataFrame, text: str, words: int = 4, seed: int = 42) -> DataFrame:
    """All columns but ``text``, and ``print``: the fingerprint of the text, NULL counting as empty."""
    ship_code(df.sparkSession)
    kept = [name for name in df.columns if name != text]
    schema = df.select(*kept, F.lit(0).cast("long").alias("print")).schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [simhash(value.as_py() or "", words, seed) for value in batch.column(text)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in kept], pa.array(prints, pa.int64())], [*kept, "print"]
            )

    return df.mapInArrow(rows, schema)


def near_duplicate_prints(prints: DataFrame, max_bits: int = 4, groups: int | None = None) -> DataFrame:
    """``print`` and ``root``, the smallest fingerprint reachable over links of ``max_bits`` differing bits or fewer.

    Fingerprints without a link are not returned. ``prints`` holds each
    fingerprint once. The segments are dealt into ``groups`` groups; points no
    more than ``max_bits`` apart have the same counts in all but ``max_bits``
    groups, so each lies with its partner in the grid cell of at least one
    choice of the other groups. No partner is left out.

    Cells are joined twice. First each fingerprint is linked to the smallest of
    its cell, which already joins most of a dense group. Then those that are still
    apart are compared, in cells of up to ``SMALL_CELL`` fingerprints all with each
    other. In larger ones those outside of the cell's largest group meet the whole
    cell, so a large group is not paired up with itself. A cell with more than
    ``DENSE_PAIRS`` pairs even so, such as one of many unlinked fingerprints with
    equal counts, is split once more, by equal bits in all but ``max_bits`` of
    ``BIT_GROUPS`` runs of bits; every link lies in one of these parts too.
    """
    if groups is None:
        groups = _group_count(prints.count(), max_bits)
    chosen = list(combinations(range(groups), groups - max_bits))
    edges = [round(SEGMENTS * i / groups) for i in range(groups + 1)]
    mask = [sum(3 << 2 * s for s in range(edges[g], edges[g + 1])) for g in range(groups)]
    points = prints.select("print", _point(F.col("print")).alias("point"))
    points = points.select("print", "point", _cells("point", mask, chosen, "choice", "cell"))
    # Written out, so that the join below may split a cell of very many fingerprints.
    least = staged(
        points.groupBy("choice", "cell").agg(F.min("print").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1"),
        "simhash-least",
    )
    shared = staged(points.join(least, ["choice", "cell"]), "simhash-cells")
    to_least = shared.where("print != least").select(F.col("print").alias("a"), F.col("least").alias("b"))
    near = _near(F.col("a"), F.col("b"), _point(F.col("a")), _point(F.col("b")), max_bits)
    first = components(to_least.where(near).distinct())
    named = staged(
        shared.join(first, shared["print"] == first["node"], "left").select(
            "choice", "cell", "print", "point", F.coalesce("root", "print").alias("root"), "n"
        ),
        "simhash-cells",
    )
    small = named.where(F.col("n") <= SMALL_CELL).drop("n")
    mixed = _mixed_cells(named.where(F.col("n") > SMALL_CELL).drop("n"), ["choice", "cell"])
    runs = max(BIT_GROUPS, 2 * max_bits)
    ends = [round(64 * i / runs) for i in range(runs + 1)]
    bits = [sum(1 << b for b in range(ends[g], ends[g + 1])) for g in range(runs)]
    split = mixed.where(F.col("pairs") > DENSE_PAIRS).select(
        "choice", "cell", "print", "point", "root",
        _cells("print", bits, list(combinations(range(runs), runs - max_bits)), "part", "bits"),
    )
    parts = _mixed_cells(split, ["choice", "cell", "part", "bits"])
    large = mixed.where(F.col("pairs") <= DENSE_PAIRS)
    links = (
        _links(small, small, ["choice", "cell"], max_bits)
        .unionAll(_links(large.where("apart"), large, ["choice", "cell"], max_bits))
        .unionAll(_links(parts.where("apart"), parts, ["choice", "cell", "part", "bits"], max_bits))
        .distinct()
    )
    return components(links.unionAll(first.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))))


def _cells(of: str, masks: list[int], chosen: list[tuple[int, ...]], choice: str, cell: str) -> Column:
    """For each choice of masks, its number and what ``of`` holds under these masks."""
    kept = [F.col(of).bitwiseAND(_signed(sum(masks[g] for g in c))) for c in chosen]
    return F.posexplode(F.array(*kept)).alias(choice, cell)


def _mixed_cells(named: DataFrame, cell: list[str]) -> DataFrame:
    """Rows of cells that hold several roots, with ``apart``: not of the cell's most frequent root.

    ``pairs`` is how many pairs of a row apart and any row the cell has.
    """
    sizes = named.groupBy(*cell, "root").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy(*cell).agg(
        F.max(F.struct("n", "root")).alias("largest"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("roots")
    )
    several = largest.where("roots > 1").select(
        *cell, F.col("largest.root").alias("main"), ((F.col("n") - F.col("largest.n")) * F.col("n")).alias("pairs")
    )
    found = named.join(staged(several, "simhash-mixed"), cell)
    return staged(found.withColumn("apart", F.col("root") != F.col("main")).drop("main"), "simhash-mixed")


def _links(left: DataFrame, right: DataFrame, cell: list[str], max_bits: int) -> DataFrame:
    """Roots ``a`` > ``b`` of a left and a right fingerprint in one cell that are near each other."""
    x, y = left.alias("x"), right.alias("y")
    same_cell = [F.col(f"x.{name}") == F.col(f"y.{name}") for name in cell]
    near = _near(F.col("x.print"), F.col("y.print"), F.col("x.point"), F.col("y.point"), max_bits)
    found = x.join(y, [*same_cell, F.col("x.root") != F.col("y.root"), near])
    return found.select(F.greatest("x.root", "y.root").alias("a"), F.least("x.root", "y.root").alias("b"))


def simhash_groups(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    words: int = 4,
    seed: int = 42,
    max_bits: int = 4,
    carry: list[str] | None = None,
) -> DataFrame:
    """Every row of ``df`` with ``fingerprint`` (hex), ``component_id`` and ``kept``.

    ``component_id`` is the smallest key reachable over links, the row's own
    included; NULL where no row of the group has a key. One row of each group is
    ``kept``: that of the smallest key, NULL last; of repeated rows one. NULL and
    blank texts have fingerprint zero and are linked like any other. ``carry``
    names the input columns to return (all by default); a result replaces an
    input column of its name. An empty table gives no rows.
    """
    names = df.columns if carry is None else carry
    rows = df.select(whole_row(df, names).alias("row"), F.col(key).alias("id"), F.col(text).alias("text"))
    with_id = rows.withColumn("uid", F.monotonically_increasing_id())
    if carry is None:  # texts come back, so that rows must be told apart in both passes
        with_id = staged(with_id, "simhash-rows")
        printed = staged(fingerprints(with_id.select("uid", "id", "text"), "text", words, seed), "simhash-prints")
    else:
        printed = staged(fingerprints(with_id.select("row", "uid", "id", "text"), "text", words, seed), "simhash-prints")
    order = F.struct(F.col("id").isNull().alias("n"), "id", "uid")
    prints = staged(printed.groupBy("print").agg(F.min(order).alias("best")), "simhash-distinct")
    roots = staged(near_duplicate_prints(prints.select("print"), max_bits), "simhash-roots")
    linked = prints.join(roots, prints["print"] == roots["node"], "left").select(
        prints["print"], F.coalesce("root", "print").alias("root"), "best"
    )
    # Written out, so that the join below may split a root of very many fingerprints.
    best = staged(linked.groupBy("root").agg(F.min("best").alias("best")), "simhash-best")
    winners = staged(linked.drop("best").join(best, "root").select("print", "best"), "simhash-winners")
    judged = printed.join(winners, "print")
    results = {
        "fingerprint": F.lower(F.lpad(F.hex("print"), 16, "0")),
        "component_id": F.col("best.id"),
        "kept": F.col("uid") == F.col("best.uid"),
    }
    if carry is None:
        judged = with_id.select("row", "uid").join(judged.select("uid", "print", "best"), "uid")
    return with_results(judged, names, results)


def _group_count(prints: int, max_bits: int) -> int:
    """Groups that make the least work: each choice of equal groups costs one row a print, and pairs by chance."""

    def work(groups: int) -> float:
        bits = SEGMENT_ENTROPY * SEGMENTS * (groups - max_bits) / groups
        return comb(groups, max_bits) * (prints + 0.1 * prints**2 / 2 ** (bits + 1))

    return min(range(max_bits + 1, 2 * max_bits + 5), key=work)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _point(bits: Column) -> Column:
    """Bits set in each two-bit segment, packed into the places of the segments."""
    shifted = F.shiftrightunsigned(bits, 1)
    low = F.lit(LOW_BITS)
    return (
        bits.bitwiseXOR(shifted)
        .bitwiseAND(low)
        .bitwiseOR(F.shiftleft(bits.bitwiseAND(shifted).bitwiseAND(low), 1))
    )


def _manhattan(p: Column, q: Column) -> Column:
    """Sum of the differences of packed counts 0 to 2: fields that differ in the low bit are one apart."""
    differ, low = p.bitwiseXOR(q), F.lit(LOW_BITS)
    one = differ.bitwiseAND(low)
    two = F.shiftrightunsigned(differ, 1).bitwiseAND(low).bitwiseAND(F.bitwise_not(one))
    return F.bit_count(one) + 2 * F.bit_count(two)


def _near(a: Column, b: Column, p: Column, q: Column, max_bits: int) -> Column:
    return (_manhattan(p, q) <= max_bits) & (F.bit_count(a.bitwiseXOR(b)) <= max_bits)
