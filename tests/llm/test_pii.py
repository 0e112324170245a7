import math
import random
import re

import pytest
from pyspark.sql import functions as F

from marketloom.llm.pii import KINDS, LABELERS, _candidates, _reliability, personal_spans, spans_text
from tests.llm import edge

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HARD = [
    "a@b.c._x@d.e-f.g and a@@b.c x@y z@w.",
    "1.2.3.4.5.6.7.8 300.1.1.1 0255.1.1.01 1.2.3 1..2.3.4 9999999999.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1112 5500005555555559 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1",
    "+1 (614) 555-8001 +49.30.123456 +1 23 +1 (826) 555-4081 4111111111111111 ++12345678901",
    "🙂 é@ü.de jo.81@mail7.example.com 🙂 19.37.233.111 ✓ +1 (741) 555-3069",
    "mail: a.b@c.org\nhost 10.0.0.1\rcard 4012888888881881",
]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return sorted(
        (m.start(), k, m.end())
        for k, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if valid(kind, m[0])
    )


def check(rows):
    for r in rows:
        want = base(r.text)
        assert [tuple(s) for s in r.base] == want, r.text[:80]
        assert [r[f"n_{kind}"] for kind in KINDS] == [sum(s[1] == k for s in want) for k in range(4)]
        assert set(map(tuple, r.base)) <= set(map(tuple, r.spans))
        assert [tuple(s) for s in r.spans] == sorted(map(tuple, r.spans))


def test_exact_spans(spark):
    df = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    check(personal_spans(df).collect())
    check(personal_spans(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect())


def test_edge_rows(spark):
    for df in (edge.documents(spark), edge.clashing(spark, "part", "cut", "placed", "base", "email_exact")):
        rows = personal_spans(df).collect()
        assert len(rows) == len(edge.ROWS)
        check(rows)
    assert {r["cut"] for r in rows} == {"mine"}
    assert personal_spans(edge.empty(spark)).count() == 0


def test_long_runs_take_linear_time(spark):
    texts = ["1 " * 60_000, "a" * 200_000, "+1" + " 2" * 60_000, "a." * 60_000 + "@", "1." * 60_000, "x@y" * 30_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = personal_spans(df).collect()
    assert [[tuple(s) for s in r.base] for r in sorted(rows, key=lambda r: r.doc_id)] == [base(t) for t in texts]


def test_learned_spans(spark):
    """Shapes the exact patterns miss are found; numbers with a false check digit are left alone."""
    filler = [f"text {i} mail user{i}@mail.example.com, call +1 (614) 555-{8000 + i}, card 4111 1111 1111 1111." for i in range(60)]
    wrong = [f"order {4111111111111112 + 7 * i} shipped" for i in range(60) if not luhn(str(4111111111111112 + 7 * i))]
    hidden = ["phone: (614) 555-8001 today", "mail me: john.doe [at] example [dot] com now"]
    df = spark.createDataFrame(list(enumerate([*filler, *wrong, *hidden])), "doc_id long, text string")
    rows = personal_spans(df).select("text", "base", spans_text("spans").alias("s")).collect()
    found = {r.text: r.s for r in rows}
    assert found[hidden[0]] == "phone:7:21"
    assert found[hidden[1]] == "email:9:40"
    assert all(found[text] == "" for text in wrong)


def test_held_out_spans(spark):
    """Nothing is added to texts without personal data, and what is added holds a true number."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = personal_spans(docs).where("size(spans) > size(base)").collect()
    for r in rows:
        for start, kind, end in set(map(tuple, r.spans)) - set(map(tuple, r.base)):
            assert KINDS[kind] == "phone" and re.fullmatch(r"\+1 \(\d{3}\) 555-\d{4}", r.text[start:end])


def test_no_python_on_the_executors(spark):
    plan = personal_spans(edge.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow", plan)


FOUND = {  # what lies between the marks is personal data
    "ip": ["server |2001:db8::1| is up", "host |::1| answered", "login from |2001:db8:0:0:0:0:2:1|, twice"],
    "phone": [
        "mon numéro |06 12 34 56 78| merci", "Büro |030 123456| in Berlin", "Handy |0171/1234567| ab acht",
        "llame al |912 345 678| hoy", "phone: |614-555-8001|", "call |614.555.8001| now",
    ],
    "email": ["write |john at mail dot example dot com| today", "correo: |ana [at] ejemplo [dot] es| gracias"],
}
LEFT_ALONE = [
    "on 01.02.2024 and 1/2/2024 we met", "std::vector a :: b", "order 4111 1111 1111 1112", "time 12:30:45 ok",
    "look at this.then go", "chapter 3.14 and 2,718 words", "meet at noon, dot your i", "0 1 2 3 4 5 6 7 8 9",
]


def test_spellings_of_several_countries(spark):
    """All planted spans are found and nothing else, among whole documents as by themselves."""
    planted = [(kind, text) for kind, texts in FOUND.items() for text in texts] + [(None, text) for text in LEFT_ALONE]
    rows = spark.createDataFrame([(-1 - i, text.replace("|", "")) for i, (_, text) in enumerate(planted)], "doc_id long, text string")
    others = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    for df in (rows, rows.unionByName(others)):
        got = {r.doc_id: r.s for r in personal_spans(df).where("doc_id < 0").select("doc_id", spans_text("spans").alias("s")).collect()}
        for i, (kind, text) in enumerate(planted):
            start = text.find("|")
            expected = "" if kind is None else f"{kind}:{start}:{text.rfind('|') - 1}"
            assert got[-1 - i] == expected, text


def plain_reliability(rows, rounds=60):
    """Expectation-maximisation vote by vote, a row for each occurrence."""
    truth = [1 / (1 + math.exp(-1.5 * sum(votes))) for votes in rows]
    for _ in range(rounds):
        share = (1 + sum(truth)) / (2 + len(rows))
        odds = []
        tables = []
        for labeler in range(len(LABELERS)):
            agree = 50.0 if labeler == 0 else 3.0
            table = {}
            for true in (0, 1):
                weights = {v: (agree if v == (1 if true else -1) else 1.0) + sum((p if true else 1 - p) for p, votes in zip(truth, rows) if votes[labeler] == v) for v in (-1, 0, 1)}
                table[true] = {v: w / sum(weights.values()) for v, w in weights.items()}
            tables.append(table)
        for votes in rows:
            odds.append(math.log(share / (1 - share)) + sum(math.log(t[1][v] / t[0][v]) for t, v in zip(tables, votes) if v))
        truth = [1 / (1 + math.exp(-max(-30.0, min(30.0, o)))) for o in odds]
    return truth


def test_reliability_against_a_plain_version():
    rng = random.Random(4)
    patterns = [tuple(rng.choice((-1, 0, 0, 1)) for _ in LABELERS) for _ in range(12)]
    counted = [(0, votes, rng.randint(1, 9)) for votes in dict.fromkeys(patterns)]
    expanded = [votes for _, votes, n in counted for _ in range(n)]
    by_votes = dict(zip(expanded, plain_reliability(expanded)))
    assert _reliability(counted, 60) == pytest.approx([by_votes[votes] for _, votes, _ in counted])


def test_votes_by_hand(spark):
    """Votes of the labelers in their order: pattern, gazetteer, context, against, apart, shape."""
    rows = [
        (1, "phone: +1 (614) 555-8001"), (2, "order 10.0.0.1x"), (3, "x 614-555-8001 y"), (4, "visa 4111 1111 1111 1112"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = _candidates(df.select(F.struct("doc_id").alias("row"), "text"))
    got = {}
    for r in found.select("row.doc_id", F.explode("found").alias("s")).collect():
        got.setdefault(r.doc_id, set()).add((KINDS[r.s.kind], r.s.start, r.s.end, *[r.s[v] for v in LABELERS]))
    assert ("phone", 7, 24, 1, 1, 1, 0, 0, 1) in got[1]
    assert ("ip", 6, 14, 1, -1, 0, -1, -1, 1) in got[2]
    assert got[3] == {("phone", 2, 14, 0, 0, 0, 0, 0, 1)}
    assert ("card", 5, 24, -1, 1, 1, 0, 0, 1) in got[4]
