"""Documents in windows of bounded length, best fit decreasing, and no window left part full.

Documents over the capacity are first cut into full windows; what remains of them
and all other documents are placed longest first, each into the tightest open
window. A segment tree over the space left tells that window's space. Only how many
pieces there are of each length reaches the driver, and equal pieces go into equal
windows a whole run at a time, which gives the windows that piece by piece gives.

A window needs padding unless it is full or as long as a power of two. Such windows
are mended last: the emptiest of them are taken apart, their pieces cut to fill the
rest, and what is left over, less than a window, goes into windows as long as powers
of two. Pieces learn on the executors, from the plan by lengths, where they go.
"""

from __future__ import annotations

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

COLUMNS = "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()
#: Token ids are handed on in pieces of so many bytes at most.
OUTPUT_BYTES = 8 << 20


@dataclass(frozen=True)
class Run:
    """``repeats`` equal windows: ``(length, copies)`` of what each holds, in order."""

    contents: tuple[tuple[int, int], ...]
    repeats: int

    @property
    def load(self) -> int:
        return sum(length * copies for length, copies in self.contents)


class SpaceTree:
    """Runs of open windows by space left; finds the least space that is large enough."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.leaves)  # a node counts the runs below it
        self.runs: list[list[Run]] = [[] for _ in range(capacity + 1)]

    def put(self, space: int, run: Run) -> None:
        self.runs[space].append(run)
        self._count(space, 1)

    def take(self, space: int) -> Run:
        self._count(space, -1)
        return self.runs[space].pop()

    def tightest(self, length: int) -> int | None:
        """The least space of at least ``length`` that some open window has."""
        node = self.leaves + length
        while not self.open[node]:
            while node & 1:  # a right child: what is larger lies beyond its parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves

    def _count(self, space: int, change: int) -> None:
        node = self.leaves + space
        while node:
            self.open[node] += change
            node >>= 1


def best_fit_decreasing(histogram: np.ndarray, capacity: int) -> list[Run]:
    """Windows for ``histogram[length]`` pieces of each length, the longest first."""
    tree = SpaceTree(capacity)
    for length in np.flatnonzero(histogram)[::-1].tolist():
        left = int(histogram[length])
        while left:
            space = tree.tightest(length)
            run = Run((), left) if space is None else tree.take(space)
            space = capacity if space is None else space
            # The window just filled stays the tightest while another piece fits.
            each = space // length
            whole, rest = min(run.repeats, left // each), 0
            if whole < run.repeats:
                rest = left - whole * each
            for copies, repeats in ((each, whole), (rest, bool(rest))):
                if repeats:
                    tree.put(space - copies * length, Run((*run.contents, (length, copies)), int(repeats)))
            untouched = run.repeats - whole - bool(rest)
            if run.contents and untouched:
                tree.put(space, Run(run.contents, untouched))
            left -= whole * each + rest
    return [run for runs in tree.runs for run in runs]


@dataclass(frozen=True)
class Plan:
    """Where pieces go, by length and rank among the pieces of that length.

    ``rows`` are (length, first rank, first sequence, copies, offset, stride): from
    the first rank on, ``copies`` pieces go to each sequence. Pieces from rank
    ``loose_from[length]`` on are cut; for them ``first sequence`` is the place of the
    first one in the stream of loose tokens, and ``stride`` the way to the next
    window's. ``gaps`` are (place in that stream, sequence, offset, size): equal
    gaps of sequences that follow each other, up to the next row's place.
    """

    capacity: int
    rows: np.ndarray
    gaps: np.ndarray
    loose_from: np.ndarray
    loose_tokens: int
    sequences: int

    def _row(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row = self.rows[np.searchsorted(self.rows[:, 0] << 44 | self.rows[:, 1], length << 44 | rank, side="right") - 1]
        later = rank - row[:, 1]
        return row, later // row[:, 3], row[:, 4] + later % row[:, 3] * length

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces that stay whole."""
        row, window, offset = self._row(length, rank)
        return row[:, 2] + window, offset

    def cut(self, length: np.ndarray, rank: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int, int, int]]]]:
        """For each loose piece by its place in the arrays: (from, to, sequence, offset) of what it is cut into."""
        row, window, offset = self._row(length, rank)
        places = row[:, 2] + window * row[:, 5] + offset
        for piece, (at, size) in enumerate(zip(places.tolist(), length.tolist(), strict=True)):
            cuts, done = [], 0
            while done < size:
                first, sequence, start, gap = self.gaps[np.searchsorted(self.gaps[:, 0], at + done, side="right") - 1].tolist()
                nth, inside = divmod(at + done - first, gap)
                end = min(size, done + gap - inside)
                cuts.append((done, end, sequence + nth, start + inside))
                done = end
            yield piece, cuts


def plan_windows(histogram: np.ndarray, capacity: int) -> Plan:
    """Best fit decreasing, and the windows that would need padding mended."""
    runs = best_fit_decreasing(histogram, capacity)
    odd = sorted((r for r in runs if r.load != capacity and r.load & (r.load - 1)), key=lambda r: (r.load, r.contents))
    whole = [r for r in runs if r.load == capacity or not r.load & (r.load - 1)]
    spare = -(-sum((capacity - r.load) * r.repeats for r in odd) // capacity)  # windows whose tokens fill all other gaps
    loose = []
    for run in odd:
        taken = min(spare, run.repeats)
        spare -= taken
        if taken:
            loose.append(Run(run.contents, taken))
        if taken < run.repeats:
            whole.append(Run(run.contents, run.repeats - taken))
    rows, gaps, used, sequence, stream = [], [], np.zeros(capacity + 1, np.int64), 0, 0

    def add(run: Run, first: int, stride: int) -> None:
        offset = 0
        for length, copies in run.contents:
            rows.append((length, int(used[length]), first, copies, offset, stride))
            used[length] += copies * run.repeats
            offset += copies * length

    for run in whole:
        add(run, sequence, 0)
        if run.load != capacity and run.load & (run.load - 1):
            gaps.append((stream, sequence, run.load, capacity - run.load))
            stream += (capacity - run.load) * run.repeats
        sequence += run.repeats
    loose_from = used.copy()
    tokens = 0
    for run in loose:
        add(run, tokens, run.load)
        tokens += run.load * run.repeats
    for bit in range(capacity.bit_length() - 1, -1, -1):
        if tokens - stream >> bit & 1:
            gaps.append((stream, sequence, 0, 1 << bit))
            stream, sequence = stream + (1 << bit), sequence + 1
    return Plan(
        capacity,
        np.array(sorted(rows), np.int64).reshape(-1, 6),
        np.array(gaps, np.int64).reshape(-1, 4),
        loose_from,
        tokens,
        sequence,
    )


def pack_windows(
    df: DataFrame,
    tokenizer: str,
    text: str = "text",
    key: str = "doc_id",
    capacity: int = 1024,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """One row for each piece of each row of ``df``: where it lies in which sequence.

    A document is its token ids and ``end_id``; NULL text counts as empty, which
    leaves ``end_id`` alone. Columns: ``doc_id`` (the key, NULL kept), ``start`` (ids
    before the piece), ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset``, and ``ids`` (little-endian 32-bit numbers) on request. Sequences are
    full or as long as a power of two; see ``sequences`` for their ids. Repeated rows
    are packed each for itself, texts of any length whole; an empty table gives no
    rows; other columns are ignored.
    """
    documents = df.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    pieces = staged(cut_documents(documents, tokenizer, capacity, end_id, with_ids), "window-pieces")
    counted = staged(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "window-counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counted.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row a length
        histogram[row["length"]] = row["n"]
    plan = plan_windows(histogram, capacity)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")))
    spark = df.sparkSession
    # A row a length: from which task and place on the pieces of that length are cut.
    loose_from = spark.createDataFrame(list(enumerate(plan.loose_from.tolist())), "length int, loose_from long")
    first_loose = (
        bases.join(F.broadcast(loose_from), "length")
        .where(F.col("base") + F.col("n") > F.col("loose_from"))
        .groupBy("length")
        .agg(F.min(F.struct("task", (F.col("loose_from") - F.col("base")).alias("place"))).alias("first_loose"))
    )
    # A row a length again, so no piece is shuffled to be told apart.
    told = pieces.join(F.broadcast(first_loose), "length", "left").withColumn(
        "loose", F.coalesce(F.struct("task", "place") >= F.col("first_loose"), F.lit(False))
    )
    ranked = told.join(bases.drop("n"), ["task", "length"]).withColumn("rank", F.col("base") + F.col("place"))
    sent = spark.sparkContext.broadcast(plan)  # grows with the capacity, not with the documents
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
    names = [*COLUMNS, *(["ids"] if with_ids else [])]
    whole = _placed(ranked.where("not loose").select(*kept, "rank"), sent).select(*names)
    if not plan.loose_tokens:
        return whole
    return whole.unionByName(_cut(ranked.where("loose").select("doc_id", "start", "length", "doc_tokens", "ids", "rank"), sent).select(*names))


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids`` of whole sequences, from pieces that carry their ids; at most one capacity each."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b"").cast("binary"), lambda before, piece: F.concat(before, piece["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def cut_documents(df: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    """Full windows and the rest of every document, numbered by ``place`` within their task and length.

    Pieces below the capacity carry their ids, as they may be cut once more.
    """
    ship_code(df.sparkSession)
    config = df.sparkSession.sparkContext.broadcast(vocabulary(tokenizer))
    kinds = {"start": "long", "length": "int", "ids_crc32": "long", "doc_tokens": "long", "task": "int", "place": "long", "ids": "binary"}
    schema = df.select("doc_id", *[F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]).schema
    arrow = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, seen = encoder(config.value), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            at, columns, held = [], [[] for _ in arrow], 0

            def batched() -> pa.RecordBatch:
                keys = batch.column(0).take(pa.array(at, pa.int64()))  # noqa: B023
                return pa.RecordBatch.from_arrays([keys, *[pa.array(v, t) for v, t in zip(columns, arrow, strict=True)]], schema.names)  # noqa: B023

            for row, value in enumerate(batch.column(1)):
                ids = np.array([*encode.ids(value.as_py() or ""), end_id], "<u4")
                for start in range(0, len(ids), capacity):
                    piece = ids[start : start + capacity].tobytes()
                    length = len(piece) // 4
                    carried = piece if with_ids or length < capacity else None
                    values = (start, length, crc32(piece), len(ids), task, seen[length], carried)
                    seen[length] += 1
                    at.append(row)
                    held += len(carried or b"")
                    for column, x in zip(columns, values, strict=True):
                        column.append(x)
                if held > OUTPUT_BYTES:
                    yield batched()
                    at, columns, held = [], [[] for _ in arrow], 0
            yield batched()

    return df.mapInArrow(rows, schema)


def _placed(ranked: DataFrame, sent) -> DataFrame:
    names = [name for name in ranked.columns if name != "rank"]
    long = F.lit(0).cast("long")
    schema = ranked.select(*names, long.alias("sequence_id"), long.alias("offset")).schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy().astype(np.int64) for n in ("length", "rank"))
            placed = sent.value.place(length, rank)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *map(pa.array, placed)], schema.names)

    return ranked.mapInArrow(rows, schema).withColumn("length", F.col("length").cast("long"))


def _cut(ranked: DataFrame, sent) -> DataFrame:
    long = F.lit(0).cast("long")
    schema = ranked.select("doc_id", "doc_tokens", *[long.alias(n) for n in ("start", "length", "ids_crc32", "sequence_id", "offset")], "ids").schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = {name: batch.column(name) for name in batch.schema.names}
            length, rank, start = (named[n].to_numpy().astype(np.int64) for n in ("length", "rank", "start"))
            at, found = [], [[] for _ in range(6)]
            for piece, cuts in sent.value.cut(length, rank):
                ids = named["ids"][piece].as_py()
                for begin, end, sequence, offset in cuts:
                    own = ids[4 * begin : 4 * end]
                    at.append(piece)
                    for column, x in zip(found, (int(start[piece]) + begin, end - begin, crc32(own), sequence, offset, own), strict=True):
                        column.append(x)
            keys = [named[n].take(pa.array(at, pa.int64())) for n in ("doc_id", "doc_tokens")]
            results = [pa.array(v, t) for v, t in zip(found, [*[pa.int64()] * 5, pa.binary()], strict=True)]
            yield pa.RecordBatch.from_arrays([*keys, *results], schema.names)

    return ranked.mapInArrow(rows, schema)
