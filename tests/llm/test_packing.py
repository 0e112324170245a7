from collections import Counter
from itertools import combinations_with_replacement
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketloom.llm.packing import enumerate_patterns, fit_plan, pack, pack_residual, sequences
from marketloom.llm.tokens import Encoder, vocabulary
from tests.llm import edge

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(PATH)


def ids_of(exact, text):
    return [*exact.encode(text or "", add_special_tokens=False).ids, 2]


def check_pieces(exact, docs, rows):
    """Every document comes back from its pieces; sequences are full and without gaps."""
    left = Counter()
    for doc_id, text in docs:
        ids = ids_of(exact, text)
        edges = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:])):
            left[doc_id, piece, a, b - a, crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == left
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(by_sequence)


def test_whole_table(spark, exact):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    packed = pack(docs, PATH, with_ids=True)
    rows = packed.collect()
    used = check_pieces(exact, [(r.doc_id, r.text) for r in docs.collect()], rows)
    least = -(-sum(r.length for r in rows) // 1024)
    assert least <= used <= least + 2
    whole = {r.sequence_id: r.ids for r in sequences(packed).collect()}
    for r in rows:
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids


def test_edge_rows(spark, exact):
    rows = pack(edge.clashing(spark, "piece", "ids", "length", "rank"), PATH).collect()
    check_pieces(exact, [r[:2] for r in edge.ROWS], rows)
    assert pack(edge.empty(spark), PATH).count() == 0


def test_ids_equal_the_tokenizer_for_every_plain_character(exact):
    encoder = Encoder(vocabulary(PATH))
    for code in range(0x500):
        for text in (f"a{chr(code)}b", f" {chr(code)}{chr(code)} 1", f"x \t{chr(code)}'ll\n{chr(code)}"):
            assert encoder.is_plain(text) and encoder.ids(text) == exact.encode(text, add_special_tokens=False).ids, code


def test_other_texts_go_to_the_tokenizer(exact):
    encoder = Encoder(vocabulary(PATH))
    for text in ("a <|endoftext|> b", "漢字 and kana かな", "🙂"):
        assert not encoder.is_plain(text) and encoder.ids(text) == exact.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(8))
def test_plans_place_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([16, 100, 1024]))
    lengths = np.minimum(1 + rng.lognormal(np.log(capacity) / 1.3, 1.0, int(rng.choice([1, 40, 3000]))).astype(int), capacity)
    histogram = np.bincount(lengths, minlength=capacity + 1)
    plan = fit_plan(histogram, capacity)
    rank = np.concatenate([np.arange(n) for n in histogram])
    length = np.repeat(np.arange(capacity + 1), histogram)
    sequence, offset = plan.place(length, rank)
    filled = np.zeros(plan.sequences, int)
    for at in np.lexsort((offset, sequence)):
        assert offset[at] == filled[sequence[at]]
        filled[sequence[at]] += length[at]
    assert (filled > 0).all() and filled.max() <= capacity
    assert plan.sequences <= sum(n for _, n in pack_residual(histogram, capacity)) + 1


@pytest.mark.parametrize("seed", range(4))
def test_all_patterns_that_fill_a_sequence(seed):
    rng = np.random.default_rng(seed)
    capacity = 30
    histogram = rng.integers(0, 3, capacity + 1)
    histogram[0] = 0
    pieces = [(0, 0), *((x, 1) for x in np.flatnonzero(histogram).tolist())]
    expected = {
        tuple(sorted((x for x, _ in three), reverse=True))
        for three in combinations_with_replacement(pieces, 3)
        if sum(x for x, _ in three) == capacity
        and all(n <= histogram[x] for x, n in Counter(x for x, _ in three if x).items())
    }
    found = [tuple(row) for row in enumerate_patterns(histogram, capacity).tolist()]
    assert len(found) == len(set(found)) and set(found) == expected


def test_no_pieces_make_no_sequences():
    assert fit_plan(np.zeros(9, np.int64), 8).sequences == 0
