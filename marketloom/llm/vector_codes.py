"""Vectors as short codes: each part of a vector becomes the number of its nearest codebook entry.

Vectors are read once, into chunks of some thousand rows. In a chunk, the points
of each part are sorted along a Hilbert curve and cut into flat blocks of equal
size; a block keeps the box around its points and their sum. A round compares
boxes with entries: an entry farther from a box than another one is from its
farthest corner cannot be nearest to any point inside, so each block has a
shortlist of entries. A shortlist of one takes the whole block by its sum; the
others are measured point by point, in integers, blocks of equal shortlists
together. Rounds send counts and sums of entries, nothing by row, and sums of
integers do not depend on the layout.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import staged, whole_row, with_results
from marketloom.llm.shipping import ship_code

#: Rows of a chunk, and points of a block.
CHUNK, BLOCK = 4096, 32
#: Scaled components stay below this, so that 64 bits hold every sum and error.
LIMIT = 1 << 26

CHUNKS = "width int, n int, widest long, points binary, places binary, low binary, high binary, total binary"


@dataclass(frozen=True)
class Compressed:
    """``codes``: input columns, ``code`` and ``error``; ``codebooks``: entries by part, entry and position."""

    codes: DataFrame
    codebooks: np.ndarray


def compress_vectors(
    df: DataFrame,
    vector: str = "embedding",
    key: str = "vec_id",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    carry: Sequence[str] | None = None,
) -> Compressed:
    """Codes of the rows of ``df`` and the codebooks that ``rounds`` of k-means give.

    Components are ``floor(scale * x)``. Codebooks start as the parts of the
    vectors with the smallest keys, ascending; equal keys follow the order of
    their vectors, NULL keys come last, and fewer rows than ``entries`` make a
    smaller codebook. An entry becomes the floored mean of the parts nearest to
    it, ties going to the lower number; an unused one stays. ``error`` is the
    squared distance to the coded vector, summed over all parts.

    Rows are dropped whose vector is NULL, empty, or holds NULL or non-finite
    components, and rows whose vectors are not as long as most (the longer, on a
    tie). Repeated rows count each for itself; an empty table gives no rows and
    empty codebooks. Lengths that ``parts`` does not divide, and components so
    large that 64 bits cannot hold the sums, are refused with ``ValueError``.
    ``carry`` names the input columns to keep, all by default; a result replaces
    one of the same name.
    """
    names = list(df.columns if carry is None else carry)
    valid = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = df.select(
        whole_row(df, names).alias("row"), F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("vector")
    ).where(valid & (F.size("vector") > 0))
    chunks = staged(chunked(kept, parts, scale), "vector-chunks")
    sizes = chunks.groupBy("width").agg(F.sum("n").alias("n"), F.max("widest").alias("widest")).orderBy(F.desc("n"), F.desc("width")).first()
    if sizes is None:
        return Compressed(_encoded(chunks, np.zeros((parts, 0, 0), np.int64), names), np.zeros((parts, 0, 0), np.int64))
    if sizes["width"] % parts:
        raise ValueError(f"vectors of {sizes['width']} components have no {parts} equal parts")
    if sizes["widest"] >= LIMIT:
        raise ValueError(f"components of {LIMIT // scale} and more are beyond exact sums of 64 bits")
    chunks = chunks.where(F.col("width") == sizes["width"])
    first = kept.where(F.size("vector") == sizes["width"]).orderBy(F.col("key").asc_nulls_last(), "vector").select("vector").limit(entries)
    codebooks = scaled(np.array([r["vector"] for r in first.collect()]), scale)  # ``entries`` rows
    codebooks = codebooks.reshape(len(codebooks), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        codebooks = moved(chunks, codebooks)
    return Compressed(_encoded(chunks, codebooks, names), codebooks)


def scaled(components: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(np.clip(components * scale, -LIMIT, LIMIT)).astype(np.int64)


@dataclass(frozen=True)
class Blocks:
    """The blocks of a chunk: ``points`` and ``places`` by part, block and place in it, boxes and sums by part and block."""

    n: int
    points: np.ndarray
    places: np.ndarray
    low: np.ndarray
    high: np.ndarray
    total: np.ndarray

    @classmethod
    def of(cls, components: np.ndarray, parts: int) -> Blocks:
        """Sorted along the curve part by part; the last block is filled up with copies of its last point."""
        n, width = len(components), components.shape[1] // parts
        blocks = -(-n // BLOCK)
        by_part = components.reshape(n, parts, width).transpose(1, 0, 2)
        places = np.stack([np.argsort(hilbert_key(points), kind="stable") for points in by_part])
        places = np.concatenate([places, np.repeat(places[:, -1:], blocks * BLOCK - n, axis=1)], axis=1)
        points = np.take_along_axis(by_part, places[:, :, None], axis=1).reshape(parts, blocks, BLOCK, width)
        total = points.sum(axis=2)
        total[:, -1] -= points[:, -1, -1] * (blocks * BLOCK - n)
        return cls(n, points, places.reshape(parts, blocks, BLOCK), points.min(axis=2), points.max(axis=2), total)

    def packed(self) -> list[bytes]:
        return [np.ascontiguousarray(a, kind).tobytes() for a, kind in zip((self.points, self.places, self.low, self.high, self.total), ("<i4", "<i4", "<i4", "<i4", "<i8"), strict=True)]

    @classmethod
    def unpacked(cls, n: int, width: int, parts: int, packed: Sequence[pa.Scalar]) -> Blocks:
        blocks, part = -(-n // BLOCK), width // parts
        shapes = [(parts, blocks, BLOCK, part), (parts, blocks, BLOCK), *[(parts, blocks, part)] * 3]
        arrays = [np.frombuffer(x.as_buffer(), kind).reshape(shape) for x, kind, shape in zip(packed, ("<i4", "<i4", "<i4", "<i4", "<i8"), shapes, strict=True)]
        return cls(n, *arrays)

    def sizes(self) -> np.ndarray:
        """Rows of each block."""
        sizes = np.full(self.points.shape[1], BLOCK)
        sizes[-1] -= len(sizes) * BLOCK - self.n
        return sizes


def shortlists(blocks: Blocks, codebooks: np.ndarray) -> np.ndarray:
    """By part, block and entry: whether the entry may be nearest to some point of the block."""
    least = most = 0
    for d in range(codebooks.shape[2]):
        entry = codebooks[:, None, :, d]
        under, over = blocks.low[:, :, None, d] - entry, entry - blocks.high[:, :, None, d]
        least = least + np.maximum(np.maximum(under, over), 0) ** 2
        most = most + np.maximum(np.abs(under), np.abs(over)) ** 2
    return least <= most.min(axis=2, keepdims=True)


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By block and point: the place of the nearest of the block's ``entries``, the first on a tie, and its squared distance."""
    if max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0)) * 2 < (1 << 15) // points.shape[2]:
        points, entries = points.astype(np.int32), entries.astype(np.int32)  # sums of squares fit
    else:
        points = points.astype(np.int64)
    distance = 0
    for d in range(points.shape[2]):
        gap = points[:, :, None, d] - entries[:, None, :, d]
        distance = distance + gap * gap
    place = distance.argmin(axis=2)
    return place, np.take_along_axis(distance, place[:, :, None], axis=2)[:, :, 0]


def measured(blocks: Blocks, codebooks: np.ndarray, listed: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of equally long shortlists together: parts, blocks, nearest entries and squared distances."""
    lengths = listed.sum(axis=2)
    for length in np.unique(lengths[lengths > 0]):
        part, block = np.nonzero(lengths == length)
        entries = np.nonzero(listed[part, block])[1].reshape(-1, length)
        place, distance = nearest(blocks.points[part, block], codebooks[part[:, None], entries])
        yield part, block, np.take_along_axis(entries, place, axis=1), distance


def tally(blocks: Blocks, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many points are nearest to each entry, and their sums."""
    parts, entries, width = codebooks.shape
    counts, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
    listed, sizes = shortlists(blocks, codebooks), blocks.sizes()
    alone = listed.sum(axis=2) == 1
    part, block = np.nonzero(alone)
    slot = part * entries + listed[part, block].argmax(axis=1)
    np.add.at(counts, slot, sizes[block])
    np.add.at(sums, slot, blocks.total[part, block])
    real = np.arange(BLOCK) < sizes[:, None]
    listed[alone] = False
    for part, block, entry, _ in measured(blocks, codebooks, listed):
        used = real[block]
        slot = (part[:, None] * entries + entry)[used]
        points = blocks.points[part, block][used]
        counts += np.bincount(slot, minlength=len(counts))
        for d in range(width):  # a chunk's sums are whole numbers below 2**53
            sums[:, d] += np.bincount(slot, points[:, d], len(counts)).astype(np.int64)
    return counts.reshape(parts, entries), sums.reshape(parts, entries, width)


def encode(blocks: Blocks, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By row of the chunk: the number of the nearest entry by part, and the squared distance over all parts."""
    codes = np.zeros((blocks.n, len(codebooks)), np.int32)
    errors = np.zeros((blocks.n, len(codebooks)), np.int64)
    for part, block, entry, distance in measured(blocks, codebooks, shortlists(blocks, codebooks)):
        place = blocks.places[part, block]
        codes[place, part[:, None]] = entry
        errors[place, part[:, None]] = distance
    return codes, errors.sum(axis=1)


def hilbert_key(points: np.ndarray) -> np.ndarray:
    """Places along a Hilbert curve through the points' box, by Skilling's transposed form.

    At most 62 bits in all, and so at most the first 62 coordinates; the order
    decides how tight blocks are, never a result.
    """
    points = points[:, :62]
    dims = points.shape[1]
    bits = min(10, 62 // dims)
    low = points.min(axis=0)
    span = max(1, int((points.max(axis=0) - low).max()))
    x = [((points[:, d] - low[d]) * ((1 << bits) - 1) // span).astype(np.int64) for d in range(dims)]
    for bit in range(bits - 1, 0, -1):
        below = (1 << bit) - 1
        for d in range(dims):
            on = (x[d] >> bit & 1).astype(bool)
            swap = np.where(on, 0, (x[0] ^ x[d]) & below)
            x[0] = x[0] ^ np.where(on, below, swap)
            if d:
                x[d] = x[d] ^ swap
    for d in range(1, dims):
        x[d] = x[d] ^ x[d - 1]
    turn = np.zeros(len(points), np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    key = np.zeros(len(points), np.int64)
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | (x[d] ^ turn) >> bit & 1
    return key


def chunked(kept: DataFrame, parts: int, scale: int) -> DataFrame:
    """A row for each chunk of rows with equally long vectors: the rows themselves and their blocks.

    Vectors that ``parts`` does not divide are counted only; they are refused or dropped.
    """
    ship_code(kept.sparkSession)
    rows = kept.select("row", "vector")
    fields = [F.lit(None).cast(kind).alias(name) for name, kind in (field.split() for field in CHUNKS.split(", "))]
    schema = rows.select(F.array("row").alias("rows"), *fields).schema

    def chunk(held: list[tuple[pa.Array, np.ndarray]]) -> pa.RecordBatch:
        members = pa.concat_arrays([row for row, _ in held])
        components = np.concatenate([vectors for _, vectors in held])
        n, width = components.shape
        widest = int(np.abs(components).max())
        blocks = [b""] * 5 if width % parts or widest >= LIMIT else Blocks.of(components, parts).packed()
        values = [[width], [n], [widest], *[[b] for b in blocks]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
        rows_ = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), members)
        return pa.RecordBatch.from_arrays([rows_, *[pa.array(v, k) for v, k in zip(values, kinds, strict=True)]], schema.names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[pa.Array, np.ndarray]]] = {}
        for batch in batches:
            vectors = batch.column(1)
            widths, components = vectors.value_lengths().to_numpy(), vectors.flatten().to_numpy()
            starts = np.cumsum(widths) - widths
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                for some in np.split(at, range(CHUNK, len(at), CHUNK)):
                    own = held.setdefault(width, [])
                    own.append((batch.column(0).take(pa.array(some)), scaled(components[starts[some][:, None] + np.arange(width)], scale)))
                    if sum(len(row) for row, _ in own) >= CHUNK:
                        yield chunk(held.pop(width))
        for own in held.values():
            yield chunk(own)

    return rows.mapInArrow(cut, schema)


def _blocks_of(batch: pa.RecordBatch, parts: int) -> Iterable[tuple[int, Blocks]]:
    named = {name: batch.column(name) for name in batch.schema.names}
    for row in range(batch.num_rows):
        packed = [named[name][row] for name in ("points", "places", "low", "high", "total")]
        yield row, Blocks.unpacked(named["n"][row].as_py(), named["width"][row].as_py(), parts, packed)


def moved(chunks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """One round: entries at the floored means of the parts nearest to them."""
    parts, entries, width = codebooks.shape
    sent = chunks.sparkSession.sparkContext.broadcast(codebooks)  # parts x entries x positions, whatever the rows
    schema = "part int, entry int, n long, " + ", ".join(f"s{d} long" for d in range(width))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for _, blocks in _blocks_of(batch, parts):
                more = tally(blocks, sent.value)
                counts += more[0]
                sums += more[1]
        part, entry = np.nonzero(counts)
        columns = [part.astype(np.int32), entry.astype(np.int32), counts[part, entry], *sums[part, entry].T]
        names = ["part", "entry", "n", *[f"s{d}" for d in range(width)]]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names)

    needed = chunks.drop("rows")
    tallies = needed.mapInArrow(count, schema).groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *[f"s{d}" for d in range(width)])])
    following = codebooks.copy()
    for row in tallies.collect():  # a row for each used entry of each part
        following[row["part"], row["entry"]] = [row[f"s{d}"] // row["n"] for d in range(width)]
    sent.unpersist()
    return following


def _encoded(chunks: DataFrame, codebooks: np.ndarray, names: Sequence[str]) -> DataFrame:
    parts = len(codebooks)
    sent = chunks.sparkSession.sparkContext.broadcast(codebooks)
    schema = chunks.select(F.get("rows", F.lit(0)).alias("row"), F.array(F.lit(0)).alias("code"), F.lit(0).cast("long").alias("error")).schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column("rows")
            for row, blocks in _blocks_of(batch, parts):
                codes, errors = encode(blocks, sent.value)
                code = pa.ListArray.from_arrays(pa.array(np.arange(blocks.n + 1) * parts, pa.int32()), pa.array(codes.ravel()))
                yield pa.RecordBatch.from_arrays([members.slice(row, 1).flatten(), code, pa.array(errors)], schema.names)

    found = chunks.mapInArrow(rows, schema)
    return with_results(found, names, {"code": F.col("code"), "error": F.col("error")})
