import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import difference, duck
from marketloom.llm import vector_codes
from marketloom.llm.oracles import ORACLES
from marketloom.llm.queries import QUERIES
from marketloom.llm.vector_codes import Blocks, compress_vectors, encode, hilbert_key, shortlists, tally

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts, entries, rounds, scale=256):
    """By definition: every part against every entry."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    lengths = Counter(len(r[1]) for r in kept)
    width = max(lengths, key=lambda n: (lengths[n], n), default=0)
    kept = [r for r in kept if len(r[1]) == width]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    points = [[[math.floor(scale * x) for x in r[1]][p * width // parts : (p + 1) * width // parts] for p in range(parts)] for r in kept]
    books = [[v[p] for v in points[:entries]] for p in range(parts)]

    def best(point, book):
        return min((sum((a - b) ** 2 for a, b in zip(point, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            owner = [best(v[p], book)[1] for v in points]
            for e in set(owner):
                own = [v[p] for v, o in zip(points, owner) if o == e]
                book[e] = [sum(x) // len(own) for x in zip(*own)]
    out = []
    for r, v in zip(kept, points):
        found = [best(v[p], book) for p, book in enumerate(books)]
        out.append((r[0], r[2], tuple(e for _, e in found), sum(d for d, _ in found)))
    return sorted(out, key=repr), books


def some_rows(seed, n, width, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, spread, (5, width))
    return [(int(i), [float(np.float32(x)) for x in centres[i % 5] + rng.normal(0, spread / 9, width)], int(i % 3)) for i in rng.permutation(n)]


def check(spark, rows, parts, entries, rounds):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = compress_vectors(df, parts=parts, entries=entries, rounds=rounds)
    got = sorted([(r.vec_id, r.label, tuple(r.code), r.error) for r in found.codes.collect()], key=repr)
    expected, books = plain(rows, parts, entries, rounds)
    assert got == expected
    assert found.codebooks.tolist() == books


@pytest.mark.parametrize(("seed", "n", "width", "parts", "entries", "rounds", "spread"), [
    (1, 300, 8, 2, 16, 2, 0.2),
    (2, 300, 12, 4, 64, 3, 3.0),
    (3, 40, 6, 6, 64, 2, 0.01),
    (4, 200, 4, 1, 7, 1, 400.0),
    (5, 30, 64, 16, 10, 0, 0.2),
])
def test_against_definition(spark, seed, n, width, parts, entries, rounds, spread, monkeypatch):
    rows = some_rows(seed, n, width, spread)
    rows += rows[:20] + [(None, rows[0][1], None), (None, rows[3][1], 1), (1, rows[5][1], None)]
    check(spark, rows, parts, entries, rounds)


def test_odd_rows(spark):
    good = some_rows(6, 50, 4, 0.3)
    bad = [
        (-1, None, 1), (-2, [], 1), (-3, [0.1, None, 0.1, 0.1], 1), (-4, [0.1, math.nan, 0.1, 0.1], 1),
        (-5, [math.inf, 0.0, 0.0, 0.0], 1), (-6, [0.0, 0.0, 0.0, -math.inf], 1), (-7, [1.0, 2.0], None), (-8, [1.0] * 5, 2),
    ]
    check(spark, good + bad, 2, 8, 2)
    check(spark, good[:1], 2, 8, 2)


def test_equal_vectors_everywhere(spark):
    check(spark, [(i, [0.5, -0.25, 0.0, 1.0], i % 2) for i in range(200)], 2, 8, 2)


def test_empty_table(spark):
    found = compress_vectors(spark.createDataFrame([], SCHEMA))
    assert found.codes.columns == ["vec_id", "embedding", "label", "code", "error"]
    assert found.codes.collect() == [] and found.codebooks.size == 0
    only_bad = compress_vectors(spark.createDataFrame([(1, None, 1), (2, [math.nan], 1)], SCHEMA))
    assert only_bad.codes.collect() == []


def test_clashing_names(spark):
    rows = some_rows(8, 30, 4, 0.3)
    names = ("row", "key", "vector", "n", "width", "code", "error", "points", "rows")
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("mine").alias(c) for c in names])
    found = compress_vectors(df, parts=2, entries=4).codes
    assert found.columns == ["vec_id", "embedding", "label", *[c for c in names if c not in ("code", "error")], "code", "error"]
    assert {(r.vec_id, tuple(r.code)) for r in found.collect()} == {(i, code) for i, _, code, _ in plain(rows, 2, 4, 2)[0]}
    assert {r.rows for r in found.collect()} == {"mine"}


def test_refusals(spark):
    with pytest.raises(ValueError, match="equal parts"):
        compress_vectors(spark.createDataFrame([(1, [1.0] * 5, 1)], SCHEMA), parts=2)
    with pytest.raises(ValueError, match="beyond exact sums"):
        compress_vectors(spark.createDataFrame([(1, [1.0, 3e38], 1)], SCHEMA), parts=2)


@pytest.mark.parametrize("n", [1, 31, 32, 33, 500])
def test_shortlists_lose_no_entry(n, monkeypatch):
    rng = np.random.default_rng(n)
    for spread in (2, 40, 3_000, 1 << 24):
        points = rng.integers(-spread, spread, (n, 6))
        points[: n // 2, 0] //= 9
        blocks = Blocks.of(points, 3)
        assert sorted(blocks.places[0].ravel()[:n].tolist()) == list(range(n))
        books = rng.integers(-spread, spread, (3, 20, 2))
        books[:, 5] = books[:, 4]
        books[:, 6] = 30 * spread  # far from all
        by_part = points.reshape(n, 3, 2).transpose(1, 0, 2)
        distances = ((by_part[:, :, None] - books[:, None]) ** 2).sum(3)
        codes, errors = encode(blocks, books)
        assert (codes.T == distances.argmin(2)).all() and (errors == distances.min(2).sum(0)).all()
        counts, sums = tally(blocks, books)
        for p in range(3):
            for e in range(20):
                own = by_part[p][distances[p].argmin(1) == e]
                assert counts[p, e] == len(own) and (sums[p, e] == own.sum(0)).all()
        assert not shortlists(blocks, books)[:, :, 6].any()


def test_blocks_of_one_entry_use_their_sum(monkeypatch):
    """Tight groups far apart, one entry each: nothing is measured point by point."""
    points = np.repeat(np.arange(4) * 1_000, 64)[:, None] + np.arange(256)[:, None] % 3
    blocks, books = Blocks.of(points, 1), (np.arange(4) * 1_000)[None, :, None]
    monkeypatch.setattr(vector_codes, "nearest", None)
    counts, sums = tally(blocks, books)
    assert counts.tolist() == [[64] * 4] and sums.sum() == points.sum()


def test_hilbert_neighbours():
    """Each place of a full grid follows one that differs by one step."""
    for dims, side in ((2, 16), (3, 8), (4, 4)):
        grid = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
        scale = (1 << min(10, 62 // dims)) // side
        cells = np.concatenate([grid * scale, np.full((1, dims), side * scale - 1)])  # spans all bits
        order = cells[np.argsort(hilbert_key(cells)[:-1], kind="stable")] // scale
        assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    got = QUERIES["op13_vector_codes"](spark, f"/root/testdata/{sf}").toPandas()
    assert difference(got, duck(f"/root/testdata/{sf}").execute(ORACLES["op13_vector_codes"]).df()) is None
