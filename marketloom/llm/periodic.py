"""Stretches of a text that repeat with a period, and the text without the repeats.

A run is a maximal stretch of words in which words a period apart are equal,
``copies`` periods long or longer. Words become numbers, and the texts of a batch
one array with a separator of its own after each, so that no run crosses texts.

Short periods are found by direct lag scans: compare the array with itself, moved
by the period. Longer ones are found scale by scale, for periods above ``P`` and up
to ``2 * P``. At a scale, every place has the hash of the ``2 * P`` words from there
on, and the least hash of every ``P`` places in a row is a minimizer. In a run,
such hashes are equal a period apart and nowhere between, since they cover a whole
period; so minimizers repeat at the period's distance, and two neighbouring
minimizers of equal hash are a seed. Four periods hold a window and the same window
a period later, so every run has a seed. Seeds are extended word by word, which also
proves them: hashes only find places. Each scale takes the hashes of the scale
before in pairs, and only texts long enough for its periods.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import whole_row, with_results
from marketloom.llm.shipping import ship_code

#: Periods up to here are scanned directly; a power of two.
DIRECT = 16
#: Words that are worked on at a time, unless a single text has more.
GROUP_WORDS = 1 << 20

RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(
    df: DataFrame, text: str = "text", carry: Sequence[str] | None = None, least: int = 6, copies: int = 4
) -> DataFrame:
    """Rows of ``df`` with ``n_words``, ``runs`` and ``collapsed``.

    Words are runs of anything but ASCII white space, numbered from 0. ``runs``
    holds ``(start, length, period)`` of every run with at least ``least`` words and
    ``copies`` periods, by start and period. ``collapsed`` is the text without the
    words that some run holds after its first period, joined by one space.

    NULL and blank texts have no words, no runs and an empty ``collapsed``. Repeated
    rows are judged each for itself, and texts of any length as a whole, in memory
    linear in the text. An empty table gives no rows. ``carry`` names the input
    columns to keep, all by default; a result replaces one of the same name.
    """
    if copies < 4:
        raise ValueError("runs of fewer than four periods need not have a seed")
    ship_code(df.sparkSession)
    names = list(df.columns if carry is None else carry)
    rows = df.select(whole_row(df, names).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = rows.select("row", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(RUNS).alias("runs"), F.col("text").alias("collapsed")).schema

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, results in collapse(batch.column(1), least, copies):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), *results], schema.names)

    found = rows.mapInArrow(judge, schema)
    return with_results(found, names, {name: F.col(name) for name in schema.names[1:]})


def collapse(texts: pa.Array, least: int = 6, copies: int = 4) -> Iterator[tuple[int, int, list[pa.Array]]]:
    """Groups of texts: place of the first, how many, and their word counts, runs and collapsed texts."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        # A word and the blank after it take two bytes or more.
        room = 2 * GROUP_WORDS + (int(sizes[first - 1]) if first else 0)
        n = max(1, int(np.searchsorted(sizes, room, side="right")) - first)
        yield first, n, _collapse(texts.slice(first, n), least, copies)
        first += n


def _collapse(texts: pa.Array, least: int, copies: int) -> list[pa.Array]:
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, owner = split.flatten(), pc.list_parent_indices(split)
    held = pc.not_equal(words, "")  # blanks at an end give an empty word
    coded = words.filter(held).dictionary_encode()
    counts = np.bincount(owner.filter(held).to_numpy(), minlength=len(texts))
    starts = np.cumsum(counts) - counts
    codes = np.empty(len(coded) + len(texts), np.int64)
    ends = starts + counts + np.arange(len(texts))  # where the separators lie
    is_word = np.ones(len(codes), bool)
    is_word[ends] = False
    codes[is_word] = coded.indices.to_numpy()
    codes[ends] = -1 - np.arange(len(texts))

    runs = np.array(find_runs(codes, counts, least, copies), np.int64).reshape(-1, 3)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = (np.cumsum(change[:-1]) == 0)[is_word]

    of = np.searchsorted(ends, runs[:, 0])
    fields = [runs[:, 0] - (ends - counts)[of], runs[:, 1], runs[:, 2]]
    found = pa.StructArray.from_arrays([pa.array(f) for f in fields], fields=list(_RUN))
    left = coded.dictionary.take(coded.indices.filter(pa.array(kept)))
    kept_counts = np.bincount(np.repeat(np.arange(len(texts)), counts)[kept], minlength=len(texts))
    joined = pc.binary_join(pa.ListArray.from_arrays(_offsets(kept_counts), left), " ")
    return [
        pa.array(counts, pa.int64()),
        pa.ListArray.from_arrays(_offsets(np.bincount(of, minlength=len(texts))), found),
        joined.cast(pa.string()),
    ]


def _offsets(counts: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())


def find_runs(
    codes: np.ndarray, counts: np.ndarray, least: int = 6, copies: int = 4, direct: int = DIRECT
) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs in texts of ``counts`` numbers, each followed by a separator of its own."""
    found = []
    for period in range(1, direct + 1):
        for start, end in _equal_stretches(codes, period, max(least, copies * period) - period):
            if _is_smallest(codes, start, period):
                found.append((start, end - start + period, period))
    hashes, width = _mixed(codes.astype(np.uint64)), 1
    origin = np.arange(len(codes))
    scale = direct
    while True:
        long_enough = counts >= copies * (scale + 1)
        if not long_enough.any():
            return found
        inside = np.repeat(long_enough, counts + 1)
        hashes, origin, counts = hashes[inside[: len(hashes)]], origin[inside], counts[long_enough]
        while width < 2 * scale:
            # Whatever is cut off at the end would reach beyond the last separator.
            hashes = _mixed(hashes[:-width] * np.uint64(0x9E3779B97F4A7C15) + hashes[width:])
            width *= 2
        found += _runs_of_seeds(codes, _seeds(hashes, scale), origin, max(least, copies * (scale + 1)), copies)
        scale *= 2


def _seeds(hashes: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of minimizers, and the distance to the next minimizer of equal hash, where a period of the scale may be."""
    lows = _slide(hashes, scale, np.minimum)
    edge = np.zeros(scale - 1, np.uint64)
    places = np.flatnonzero(_slide(np.concatenate([edge, lows, edge]), scale, np.maximum) == hashes)
    places = places[np.argsort(hashes[places], kind="stable")]
    distance = places[1:] - places[:-1]
    equal = hashes[places[1:]] == hashes[places[:-1]]
    seed = equal & (distance > scale) & (distance <= 2 * scale)
    return places[:-1][seed], distance[seed]


def _runs_of_seeds(
    codes: np.ndarray, seeds: tuple[np.ndarray, np.ndarray], origin: np.ndarray, least: int, copies: int
) -> list[tuple[int, int, int]]:
    place, period = origin[seeds[0]], seeds[1]
    order = np.lexsort((place, period))
    found, known, until = [], 0, 0
    for at, lag in zip(place[order].tolist(), period[order].tolist(), strict=True):
        if lag == known and at < until:
            continue  # another seed of the stretch before
        start = at - _common(codes[:at][::-1], codes[lag : at + lag][::-1])
        known, until = lag, at + _common(codes[at:], codes[at + lag :])
        length = until - start + lag
        if length >= max(least, copies * lag) and _is_smallest(codes, start, lag):
            found.append((start, length, lag))
    return found


def _equal_stretches(codes: np.ndarray, lag: int, least: int) -> Iterable[tuple[int, int]]:
    """Stretches of ``least`` places or more that all equal the place ``lag`` later."""
    equal = np.zeros(max(0, len(codes) - lag) + 2, bool)
    equal[1:-1] = codes[lag:] == codes[:-lag]
    edges = np.flatnonzero(equal[1:] != equal[:-1])
    starts, ends = edges[::2], edges[1::2]
    long_enough = ends - starts >= least
    return zip(starts[long_enough].tolist(), ends[long_enough].tolist(), strict=True)


def _is_smallest(codes: np.ndarray, start: int, period: int) -> bool:
    """No divisor of the period is a period too; others cannot be, in two periods or more."""
    rest, prime = period, 2
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        if rest % prime == 0:
            lag = period // prime
            if np.array_equal(codes[start : start + period], codes[start + lag : start + lag + period]):
                return False
            while rest % prime == 0:
                rest //= prime
        prime += 1
    return True


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many numbers are equal from the start on."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        end = min(n, at + step)
        differ = a[at:end] != b[at:end]
        if differ.any():
            return at + int(differ.argmax())
        at, step = end, 2 * step
    return n


def _slide(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The least or greatest of every ``width`` values in a row; ``width`` is a power of two."""
    step = 1
    while step < width:
        values = best(values[:-step], values[step:])
        step *= 2
    return values


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread over 64 bits by shifts and odd factors."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
