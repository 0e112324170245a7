import re
import time
from collections import Counter

from marketloom.llm.quality import judge_lines
from tests.llm import edge

FIGURES = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()


def figures(text):
    text = text or ""
    word = r"[^\x20\x09-\x0D]+"
    words = re.findall(word, text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(word, line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
        len(words) < 50 or 100 * len(repeated) > 50 * len(words),
    )


def test_figures_on_edge_rows(spark):
    for df in (edge.documents(spark), edge.clashing(spark, "words", "lines", "sorted", "n_words")):
        rows = judge_lines(df).collect()
        assert len(rows) == len(edge.ROWS)
        for r in rows:
            assert tuple(r[f] for f in FIGURES) == figures(r.text), r.doc_id
    assert {r["words"] for r in rows} == {"mine"}
    assert judge_lines(edge.empty(spark)).count() == 0
    assert [r.clean_text for r in rows if r.doc_id == 5] == [None]



def prose_line(i):
    return " ".join(f"word{i}{c}" for c in "abcdefghijkl") + "."


def judged(spark, *lines):
    text = "\n".join(lines)
    return judge_lines(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()


def test_each_rule_removes_its_lines(spark):
    prose = [prose_line(i) for i in range(12)]
    bad = [
        "Home | News | Sports | Contact",
        "buy&&& this### now$$$",
        "NOW!! ONLY!! TODAY!!",
        "one two three four five six seven eight nine ten eleven",
        "We use cookies, see our Privacy Policy.",
    ]
    for line in bad:
        row = judged(spark, *prose[:6], line, *prose[6:])
        assert row.clean_text.split("\n") == prose and row.kept, line
    row = judged(spark, *prose, "", "short line", "a | b.", *prose[:1])
    assert row.lost_words == 0 and row.clean_text == row.text


def test_a_long_line_may_mention_a_phrase(spark):
    prose = [prose_line(i) for i in range(6)]
    assert judged(spark, *prose, f"click here {prose_line(7)}").lost_words == 0
    assert judged(spark, *prose, "Click here for our privacy policy today.").clean_text.split("\n") == prose


def test_very_many_failing_lines(spark):
    """Linear in the lines: 80,000 that fail, between some that stay."""
    lines = [f"Home | News | {i}" if i % 4 else prose_line(i) for i in range(107_000)]
    began = time.monotonic()
    row = judged(spark, *lines)
    assert time.monotonic() - began < 15
    assert row.clean_text.split("\n") == lines[::4]


def test_texts_that_lose_too_much_go(spark):
    prose = [prose_line(i) for i in range(6)]
    menu = " | ".join(f"item{i}" for i in range(15))
    assert judged(spark, *prose, menu).kept  # loses 29 of 101 words
    assert not judged(spark, *prose[:5], menu).kept


def test_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = judge_lines(spark.read.parquet(f"{folder}/documents.parquet")).join(labels, "doc_id").collect()
    sound = [r for r in rows if not r.base_failed]
    assert all(r.kept == (r.quality == 1) for r in sound) and {r.quality for r in sound} == {0, 1}
    for r in sound:
        if r.quality == 1:
            assert r.clean_text == "\n".join(line for line in r.text.split("\n") if line != "All rights reserved.")


def test_no_python_and_no_shuffle(spark):
    plan = judge_lines(edge.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange", plan)
