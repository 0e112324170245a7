import hashlib
import random
import re
from zlib import crc32

import pyarrow as pa
import pytest

from marketloom.llm import periodic
from marketloom.llm.periodic import collapse, periodic_runs
from marketloom.llm.queries import QUERIES, with_repeats
from tests.llm import edge

SMALL = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def all_runs(words, least=6, copies=4):
    """By definition: every lag, every stretch, and no smaller period."""
    found = []
    for lag in range(1, len(words) // copies + 1):
        at = 0
        while at + lag < len(words):
            end = at
            while end + lag < len(words) and words[end] == words[end + lag]:
                end += 1
            length = end - at + lag
            if length >= max(least, copies * lag) and not any(
                all(words[i] == words[i + p] for i in range(at, at + length - p)) for p in range(1, lag)
            ):
                found.append((at, length, lag))
            at = max(end, at + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def without_repeats(words, runs):
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in dropped)


def some_words(rng):
    words = []
    for _ in range(rng.randint(0, 4)):
        if rng.random() < 0.6:
            block = rng.choices(range(rng.choice([1, 2, 3, 50])), k=rng.randint(1, rng.choice([3, 40, 150])))
            block *= rng.randint(1, 2)
            words += (block * 8)[: int(len(block) * rng.uniform(1, 7))]
            if words and rng.random() < 0.3:
                words[rng.randrange(len(words))] = 99
        else:
            words += rng.choices(range(rng.choice([2, 5, 100])), k=rng.randint(0, 80))
    return list(map(str, words))


@pytest.mark.parametrize("seed", range(20))
@pytest.mark.parametrize("group", [1, 300, 1 << 20])
def test_all_runs_of_random_texts(seed, group, monkeypatch):
    monkeypatch.setattr(periodic, "GROUP_WORDS", group)
    rng = random.Random(seed)
    texts = [some_words(rng) for _ in range(9)]
    seen = 0
    for first, n, (counts, runs, left) in collapse(pa.array([" ".join(t) for t in texts])):
        assert first == seen
        seen += n
        for words, count, found, text in zip(texts[first : first + n], counts.to_pylist(), runs.to_pylist(), left.to_pylist(), strict=True):
            expected = all_runs(words)
            assert count == len(words)
            assert [(r["start"], r["length"], r["period"]) for r in found] == expected
            assert text == without_repeats(words, expected)
    assert seen == len(texts)


def test_long_periods_and_equal_neighbours():
    """Periods at the edges of the scales, and two texts of the same words, which are no run together."""
    rng = random.Random(7)
    texts = []
    for period in (1, 15, 16, 17, 31, 32, 33, 63, 64, 65, 128, 129, 500, 1025):
        block = [str(rng.random()) for _ in range(period)]
        for length in (4 * period - 1, 4 * period, 4 * period + 1, 6 * period):
            texts += [["x", *(block * 6)[:length], "y"]] * 2
    (_, _, (_, runs, _)), = collapse(pa.array([" ".join(t) for t in texts]))
    at = 0
    for period in (1, 15, 16, 17, 31, 32, 33, 63, 64, 65, 128, 129, 500, 1025):
        for length in (4 * period - 1, 4 * period, 4 * period + 1, 6 * period):
            expected = [{"start": 1, "length": length, "period": period}] if length >= max(6, 4 * period) else []
            assert runs[at].as_py() == runs[at + 1].as_py() == expected
            at += 2


def test_runs_within_runs():
    block = ["a"] * 10 + ["b"] + ["c", "d"] * 8
    words = block * 5
    (_, _, (_, runs, left)), = collapse(pa.array([" ".join(words)]))
    expected = all_runs(words)
    assert (0, 135, 27) in expected and len(expected) == 11
    assert [(r["start"], r["length"], r["period"]) for r in runs[0].as_py()] == expected
    assert left[0].as_py() == without_repeats(words, expected)


def test_least_and_copies():
    (_, _, (_, runs, _)), = collapse(pa.array(["a a a a a"]), least=5, copies=5)
    assert runs.to_pylist() == [[{"start": 0, "length": 5, "period": 1}]]
    (_, _, (_, runs, _)), = collapse(pa.array(["a a a a a"]))
    assert runs.to_pylist() == [[]]


def test_too_few_copies(spark):
    with pytest.raises(ValueError, match="four periods"):
        periodic_runs(edge.documents(spark), copies=3)


def test_edge_rows(spark):
    docs = edge.clashing(spark, "runs", "n_words", "text_", "collapsed")
    found = periodic_runs(docs)
    assert found.columns == [*[c for c in docs.columns if c not in ("runs", "n_words", "collapsed")], "n_words", "runs", "collapsed"]
    rows = found.collect()
    assert len(rows) == len(edge.ROWS)
    for r in rows:
        words = words_of(r.text)
        runs = [tuple(run) for run in r.runs]
        assert r.n_words == len(words)
        assert r.task == "mine"
        if r.text == edge.LONG:
            assert runs == [(0, 72_000, 6)] and r.collapsed == "many words make a long text."
        else:
            assert runs == all_runs(words) and r.collapsed == without_repeats(words, runs)
    assert periodic_runs(edge.empty(spark)).count() == 0


def planted(doc_id, text):
    words = words_of(text)
    h = crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_planted_repeats(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 97))) for i in range(2_000)] + edge.ROWS
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    changed = with_repeats(docs).collect()
    assert sorted((str(r.doc_id), words_of(r.text)) for r in changed) == sorted((str(i), planted(i, t)) for i, t in (r[:2] for r in rows))


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op12_periodic_runs"](spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    with_runs = 0
    for r in rows:
        words = planted(r.doc_id, texts[r.doc_id])
        if len(words) > 2_000:
            continue
        runs = all_runs(words)
        with_runs += bool(runs)
        start, length, period = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), start, length, period)
        assert r.exponent_milli == (1000 * length // period if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(without_repeats(words, runs).encode()).hexdigest()
    assert with_runs > 5
