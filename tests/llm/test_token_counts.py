import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from marketloom.llm.token_counts import Counter, apply_edits, build, edited_counts, masked, token_trees
from marketloom.llm.tokens import Encoder, vocabulary
from tests.llm import edge

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def counter():
    return Counter(Encoder(vocabulary(PATH)))


@pytest.mark.parametrize("seed", range(150))
def test_edits_give_the_count_of_the_edited_text(counter, seed):
    rng = random.Random(seed)
    letters = rng.choice(["ab 's1!\n  é'llx-", "hello  world 12 ,.\n\t're ça", "   \n\n x", "漢字 a 🙂  b"])

    def some(sizes):
        return "".join(rng.choice(letters) for _ in range(rng.choice(sizes)))

    text = some((0, 3, 50, 700, 4000))
    tree = build(text, counter)
    assert tree.total == len(counter.encode.ids(text))
    for _ in range(2):  # edits on an edited tree too
        places = sorted(rng.sample(range(len(text) + 1), min(len(text) + 1, 2 * rng.randint(0, 6)) // 2 * 2))
        edits = [(a, b, some((0, 1, 5, 900))) for a, b in zip(places[::2], places[1::2])]
        new = text
        for a, b, inserted in reversed(edits):
            new = new[:a] + inserted + new[b:]
        tree, _ = apply_edits(text, tree, edits, counter)
        text = new
        assert tree.total == len(counter.encode.ids(text)) and tree.chars[1] == len(text)
        width = len(tree.chars) // 2
        assert all(tree.tokens[i] == tree.tokens[2 * i] + tree.tokens[2 * i + 1] for i in range(1, width))


NAME = "<|endoftext|>"


@pytest.mark.parametrize(("text", "tokens"), [
    (f"x {NAME} y", 4), (NAME * 3, 3), (f"a  {NAME}  b", None), (NAME[:-1], None), (f"<{NAME}>", None), (f"\n\n{NAME}\n", None),
])
def test_added_tokens_are_one_token_each(counter, text, tokens):
    assert build(text, counter).total == len(counter.encode.ids(text)) == (tokens or len(counter.encode.ids(text)))


@pytest.mark.parametrize("seed", range(120))
def test_edits_that_make_break_or_touch_added_tokens(counter, seed):
    rng = random.Random(seed)
    parts = [NAME, NAME[:5], NAME[5:], NAME[:-1], "|>", "<|", " ", "  ", "word ", "\n\n", "it's", "<"]

    def some(n):
        return "".join(rng.choice(parts) for _ in range(n))

    text = some(rng.choice((0, 4, 60, 900)))
    tree = build(text, counter)
    assert tree.total == len(counter.encode.ids(text))
    for _ in range(3):
        places = sorted(rng.sample(range(len(text) + 1), min(len(text) + 1, 2 * rng.randint(0, 6)) // 2 * 2))
        edits = [(a, min(b, a + rng.choice((0, 1, 6, 400))), rng.choice(["", "", NAME, "|>", "endoftext", some(3)])) for a, b in zip(places[::2], places[1::2])]
        new = text
        for a, b, inserted in reversed(edits):
            new = new[:a] + inserted + new[b:]
        tree, _ = apply_edits(text, tree, edits, counter)
        text = new
        assert tree.total == len(counter.encode.ids(text)) and tree.chars[1] == len(text)


def test_added_tokens_in_rows(spark, counter):
    rows = [(1, f"a {NAME} b"), (2, f"12{NAME}34 " * 300), (3, "<|endof22text|>"), (3, "<|endof22text|>"), (None, NAME)]
    docs = masked(spark.createDataFrame(rows, "doc_id long, text string"), "[0-9]{2,}", "")
    for r in edited_counts(token_trees(docs, PATH), PATH).collect():
        assert r.n_tokens == len(counter.encode.ids(r.text))
        assert r.n_tokens_after == len(counter.encode.ids(re.sub("[0-9]{2,}", "", r.text)))


def test_only_touched_regions_are_encoded(counter):
    text = "some words and more words. " * 4000
    tree = build(text, counter)
    _, encoded = apply_edits(text, tree, [(50_000, 50_004, "NEW")], counter)
    assert 0 < encoded < 300


def test_rows(spark, counter):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(edge.documents(spark))
    rows = edited_counts(token_trees(masked(docs.select("doc_id", "text"), r"[0-9]{2,}|[&]+", "#"), PATH), PATH).collect()
    import re

    assert len(rows) == docs.count()
    for r in rows:
        assert r.n_tokens == len(counter.encode.ids(r.text or ""))
        assert r.n_tokens_after == len(counter.encode.ids(re.sub(r"[0-9]{2,}|[&]+", "#", r.text or "")))
        assert len(r.edits) == len(re.findall(r"[0-9]{2,}|[&]+", r.text or "")) and (r.n_encoded > 0) >= (len(r.edits) > 0)


def test_empty_table_and_clashing_names(spark):
    assert token_trees(masked(edge.empty(spark), "x", ""), PATH).count() == 0
    df = edge.clashing(spark, "tree", "text_", "leaves", "encoded").withColumn("edits", F.lit(None).cast("array<struct<start:int,end:int,text:string>>"))
    rows = edited_counts(token_trees(df, PATH), PATH).collect()
    assert len(rows) == len(edge.ROWS) and {r["leaves"] for r in rows} == {"mine"}
    assert all(r.n_tokens_after == r.n_tokens and r.n_encoded == 0 for r in rows)
