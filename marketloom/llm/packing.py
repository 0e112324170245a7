"""Documents packed into sequences of bounded length, by patterns of lengths.

Only the histogram of lengths reaches the driver, a number for each length up to
the capacity. Patterns of one to three documents that fill a sequence exactly
are fitted to it by non-negative least squares, the fit is rounded to whole
repeats, and what remains is packed by best fit, largest first, in runs of equal
pieces. The plan then says which ranks of each length go to which sequences;
pieces are ranked and placed on the executors.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import staged
from marketloom.llm.shipping import ship_code
from marketloom.llm.tokens import encoder, vocabulary

PLACED = "doc_id, piece, start, length, ids_crc32, sequence_id, offset"


@dataclass(frozen=True)
class Plan:
    """For each length, in order of rank: where the pieces from rank ``first`` on go."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    copies: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces by length and rank among that length."""
        row = np.searchsorted(self.length << 44 | self.first, length << 44 | rank, side="right") - 1
        later = rank - self.first[row]
        copies = self.copies[row]
        return self.sequence[row] + later // copies, self.offset[row] + later % copies * length


def pack(
    df: DataFrame,
    tokenizer: str,
    text: str = "text",
    key: str = "doc_id",
    capacity: int = 1024,
    end_id: int = 2,
    with_ids: bool = False,
) -> DataFrame:
    """One row for each piece of each row of ``df``: where it lies in which sequence.

    A document is its token ids and ``end_id``; NULL text counts as empty, which
    leaves ``end_id`` alone. Documents over ``capacity`` are cut into full pieces,
    the first of which may be shorter. Columns: ``doc_id`` (the key, NULL kept),
    ``piece``, ``start`` (ids before it), ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset``, and ``ids`` on request. Repeated rows are packed
    each for itself; an empty table gives no rows; other columns are ignored.
    """
    pieces = staged(cut(df.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), tokenizer, capacity, end_id, with_ids), "pieces")
    counted = staged(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counted.groupBy("length").agg(F.sum("n").alias("n")).collect():  # capacity rows at most
        histogram[row["length"]] = row["n"]
    plan = fit_plan(histogram, capacity)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["task", "length"]).select(
        *[name for name in pieces.columns if name not in ("task", "place")],
        (F.col("base") + F.col("place")).alias("rank"),
    )
    return _placed(ranked, plan, with_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids`` of whole sequences, from pieces that carry their ids; at most one capacity each."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))


def cut(df: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """Pieces of ``doc_id, text`` rows, numbered by ``place`` within their task and length."""
    ship_code(df.sparkSession)
    config = df.sparkSession.sparkContext.broadcast(vocabulary(tokenizer))
    schema = df.select(
        "doc_id",
        *[F.lit(0).cast(kind).alias(name) for name, kind in (("piece", "int"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"), ("task", "long"), ("place", "long"))],
        *([F.array(F.lit(0)).alias("ids")] if with_ids else []),
    ).schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, seen = encoder(config.value), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            at, columns = [], {name: [] for name in schema.names[1:]}
            for row, value in enumerate(batch.column(1)):
                ids = np.array([*encode.ids(value.as_py() or ""), end_id], "<u4")
                edges = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                if len(ids) <= capacity:
                    edges = [0, len(ids)]
                for piece, (start, end) in enumerate(zip(edges, edges[1:], strict=False)):
                    at.append(row)
                    length = end - start
                    values = (piece, start, length, crc32(ids[start:end].tobytes()), task, seen[length], ids[start:end].astype(np.int32))
                    seen[length] += 1
                    for name, value_ in zip(columns, values, strict=False):
                        columns[name].append(value_)
            arrays = [pa.array(v, t) for v, t in zip(columns.values(), [pa.int32(), *[pa.int64()] * 5, pa.list_(pa.int32())], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *arrays], schema.names)

    return df.mapInArrow(rows, schema)


def _placed(ranked: DataFrame, plan: Plan, with_ids: bool) -> DataFrame:
    names = [n for n in ranked.columns if n not in ("rank", "ids")]
    ranked = ranked.select(*names, "rank", *(["ids"] if with_ids else []))
    long = F.lit(0).cast("long")
    schema = ranked.select(*names, long.alias("sequence_id"), long.alias("offset"), *(["ids"] if with_ids else [])).schema
    chosen = ranked.sparkSession.sparkContext.broadcast(plan)  # grows with the capacity, not with the documents

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            sequence, offset = chosen.value.place(length, rank)
            arrays = [batch.column(n) for n in names] + [pa.array(sequence), pa.array(offset)]
            arrays += [batch.column("ids")] if with_ids else []
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return ranked.mapInArrow(rows, schema).select(*[c.strip() for c in PLACED.split(",")], *(["ids"] if with_ids else []))


def fit_plan(histogram: np.ndarray, capacity: int, steps: int = 300) -> Plan:
    """Sequences for ``histogram[length]`` pieces of each length.

    Short pieces fill gaps best, so the fit is made with all lengths and with the
    shortest left to the residual; the plan of the fewest sequences is taken.
    """
    patterns = enumerate_patterns(histogram, capacity)
    fits = []
    for reserve in (0, capacity // 16, capacity // 8, capacity // 4):
        usable = patterns[((patterns >= reserve) | (patterns == 0)).all(1)]
        fits.append(_rounded(usable, fit_repeats(usable, histogram, steps), histogram, capacity))
    return _number(min(fits, key=lambda runs: sum(repeats for _, repeats in runs)))


def _rounded(patterns: np.ndarray, wanted: np.ndarray, histogram: np.ndarray, capacity: int) -> list:
    """Whole repeats of the patterns, as far as there are pieces, and the rest by best fit."""
    left, runs = histogram.copy(), []
    for at in np.argsort(-wanted, kind="stable"):
        if wanted[at] < 0.5:
            break
        need = Counter(int(x) for x in patterns[at] if x)
        repeats = min(round(float(wanted[at])), *(int(left[x]) // n for x, n in need.items()))
        if repeats > 0:
            runs.append((tuple(sorted(need.items(), reverse=True)), repeats))
            for x, n in need.items():
                left[x] -= n * repeats
    return runs + pack_residual(left, capacity)


def enumerate_patterns(histogram: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of three lengths, padded by 0, of pieces that occur and fill a sequence exactly.

    All singles, pairs and triples, at most about ``capacity``² / 12 of them.
    """
    present = np.flatnonzero(histogram)
    full = [np.array([[capacity, 0, 0]])] if histogram[capacity] else []
    a = present[present < capacity]
    pairs = a[(histogram[capacity - a] > 0) & (2 * a >= capacity)]
    full.append(np.stack([pairs, capacity - pairs, 0 * pairs], 1))
    for least in a[3 * a <= capacity]:
        middle = a[(a >= least) & (2 * a <= capacity - least)]
        largest = capacity - least - middle
        there = histogram[largest] > 0
        full.append(np.stack([largest[there], middle[there], np.full(there.sum(), least)], 1))
    found = np.concatenate(full)
    need = np.stack([(found == found[:, [i]]).sum(1) <= histogram[found[:, i]] for i in range(3)], 1) | (found == 0)
    return found[need.all(1)]


def fit_repeats(patterns: np.ndarray, histogram: np.ndarray, steps: int) -> np.ndarray:
    """Non-negative repeats whose use of lengths is nearest to the histogram in least squares.

    Accelerated projected gradient; the step follows from the largest eigenvalue.
    """
    if not len(patterns):
        return np.zeros(0)
    flat = patterns.ravel()

    def used(x: np.ndarray) -> np.ndarray:
        total = np.bincount(flat, np.repeat(x, 3), len(histogram))
        total[0] = 0
        return total

    def pull(by_length: np.ndarray) -> np.ndarray:
        return by_length[patterns].sum(1)

    x = np.ones(len(patterns))
    for _ in range(20):
        x = pull(used(x))
        largest = np.linalg.norm(x)
        x /= largest
    target = histogram.astype(float)
    target[0] = 0
    x = ahead = np.zeros(len(patterns))
    momentum = 1.0
    for _ in range(steps):
        new = np.maximum(0, ahead - pull(used(ahead) - target) / (1.05 * largest))
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / following * (new - x)
        x, momentum = new, following
    return x


def pack_residual(left: np.ndarray, capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best fit, largest first, for runs of equal pieces into runs of equal sequences."""
    room: list[list[list]] = [[] for _ in range(capacity + 1)]  # by space left: [contents, repeats]
    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            space = next((s for s in range(length, capacity + 1) if room[s]), None)
            if space is None:
                each = capacity // length
                for copies, repeats in ((each, n // each), (n % each, 1)):
                    if copies and repeats:
                        room[capacity - copies * length].append([((length, copies),), repeats])
                break
            contents, repeats = room[space].pop()
            taken = min(n, repeats)
            if taken < repeats:
                room[space].append([contents, repeats - taken])
            grown = dict(contents)
            grown[length] = grown.get(length, 0) + 1
            room[space - length].append([tuple(grown.items()), taken])
            n -= taken
    return [(contents, repeats) for runs in room for contents, repeats in runs]


def _number(runs: list[tuple[tuple[tuple[int, int], ...], int]]) -> Plan:
    used: Counter = Counter()
    rows, sequence = [], 0
    for contents, repeats in runs:
        offset = 0
        for length, copies in contents:
            rows.append((length, used[length], sequence, copies, offset))
            used[length] += copies * repeats
            offset += copies * length
        sequence += repeats
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Plan(*table.T.copy(), sequence)
