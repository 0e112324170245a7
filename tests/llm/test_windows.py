import random
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketloom.llm.queries import QUERIES
from marketloom.llm.windows import SpaceTree, Run, best_fit_decreasing, pack_windows, plan_windows, sequences
from tests.llm import edge

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(PATH)


def spaces_piece_by_piece(lengths, capacity):
    spaces = []
    for length in sorted(lengths, reverse=True):
        at = bisect_left(spaces, length)
        insort(spaces, (capacity if at == len(spaces) else spaces.pop(at)) - length)
    return spaces


def some_lengths(rng, capacity):
    kind = rng.random()
    if kind < 0.3:
        return [rng.randint(1, capacity) for _ in range(rng.randint(0, 200))]
    if kind < 0.6:
        return [rng.choice([capacity * 6 // 10, capacity // 3 + 1, capacity // 2 + 1]) for _ in range(rng.randint(1, 300))]
    return [max(1, min(capacity, int(rng.expovariate(1) * capacity / 5))) for _ in range(rng.randint(0, 500))]


@pytest.mark.parametrize("seed", range(60))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 16, 64, 100, 1024])
    lengths = some_lengths(rng, capacity)
    histogram = np.bincount(lengths, minlength=capacity + 1)
    runs = best_fit_decreasing(histogram, capacity)
    assert sorted(capacity - r.load for r in runs for _ in range(r.repeats)) == spaces_piece_by_piece(lengths, capacity)
    plan, held = plan_windows(histogram, capacity), defaultdict(list)
    for length in np.flatnonzero(histogram).tolist():
        n, loose_from = int(histogram[length]), int(plan.loose_from[length])
        for sequence, offset in zip(*plan.place(np.full(loose_from, length), np.arange(loose_from))):
            held[int(sequence)].append((int(offset), length))
        for _, cuts in plan.cut(np.full(n - loose_from, length), np.arange(loose_from, n)):
            assert [cuts[0][0], *[c[1] for c in cuts]] == [*[c[0] for c in cuts], length]
            for begin, end, sequence, offset in cuts:
                held[sequence].append((offset, end - begin))
    assert sorted(held) == list(range(plan.sequences))
    loads = []
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        loads.append(at)
    assert all(at == capacity or at & (at - 1) == 0 for at in loads)
    assert sum(loads) == sum(lengths)


def test_whole_documents_stay_whole_where_they_fit():
    histogram = np.zeros(1025, np.int64)
    histogram[[1000, 24, 512]] = 7, 7, 3
    plan = plan_windows(histogram, 1024)
    assert plan.loose_tokens == 0 and plan.sequences == 9


def test_tree():
    rng, tree, spaces = random.Random(3), SpaceTree(1024), []
    for _ in range(3_000):
        if rng.random() < 0.55 or not spaces:
            spaces.append(rng.randint(0, 1024))
            tree.put(spaces[-1], Run((), spaces[-1]))
        else:
            length = rng.randint(0, 1024)
            least = min((s for s in spaces if s >= length), default=None)
            assert tree.tightest(length) == least
            if least is not None:
                assert tree.take(least).repeats == least
                spaces.remove(least)


def check(exact, docs, rows, capacity=1024):
    """Every document comes back from its pieces; no sequence has a hole or needs padding."""
    left, by_sequence = Counter(), defaultdict(list)
    documents = Counter()
    for doc_id, text in docs:
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        documents[doc_id, len(ids)] += 1
        left.update((doc_id, int(i)) for i in ids)
    for r in rows:
        assert r.length == len(r.ids) // 4 and r.ids_crc32 == crc32(r.ids)
        left.subtract((r.doc_id, int(i)) for i in np.frombuffer(r.ids, "<u4"))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert not any(left.values())
    covered = defaultdict(Counter)
    for r in rows:
        covered[r.doc_id, r.doc_tokens].update(range(r.start, r.start + r.length))
    assert {k: len(c) for k, c in covered.items()} == {k: k[1] for k in documents}
    assert all(set(c.values()) == {documents[k]} for k, c in covered.items())
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at == capacity or at & (at - 1) == 0 and at < capacity
    return len(by_sequence)


def test_whole_table(spark, exact):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    packed = pack_windows(docs, PATH, with_ids=True)
    rows = packed.collect()
    used = check(exact, texts, rows)
    total = sum(r.length for r in rows)
    assert used == total // 1024 + (total % 1024).bit_count()
    whole = {r.sequence_id: bytes(r.ids) for r in sequences(packed).collect()}
    for r in rows:
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == r.ids
        ids = np.array([*exact.encode(dict(texts)[r.doc_id] or "", add_special_tokens=False).ids, 0], "<u4")
        assert ids[r.start : r.start + r.length].tobytes() == r.ids


def test_only_pieces_that_leave_gaps(spark, exact):
    """Nothing fits beside another piece, so every window is mended."""
    texts = [(i, "word " * n) for i, n in enumerate([9] * 50 + [11] * 30)]
    rows = pack_windows(spark.createDataFrame(texts, "doc_id long, text string").repartition(4), PATH, capacity=16, with_ids=True).collect()
    check(exact, texts, rows, 16)


def test_edge_rows(spark, exact):
    docs = edge.clashing(spark, "start", "ids", "length", "rank", "loose", "place", "base")
    rows = pack_windows(docs, PATH, with_ids=True).collect()
    check(exact, [r[:2] for r in edge.ROWS], rows)
    assert pack_windows(edge.empty(spark), PATH).collect() == []


def test_query(spark, exact):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    found = QUERIES["op11_best_fit_windows"](spark, "/root/testdata/sf0.001")
    assert found.columns == "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()
    assert [kind for _, kind in found.dtypes] == ["bigint"] * 7
    tokens = Counter()
    for r in found.collect():
        ids = np.array([*exact.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0], "<u4")
        assert r.doc_tokens == len(ids) and r.ids_crc32 == crc32(ids[r.start : r.start + r.length].tobytes())
        tokens[r.doc_id] += r.length
    assert set(tokens) == set(texts)
