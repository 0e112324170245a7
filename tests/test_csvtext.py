"""The CSV dialect, against Python's own csv module."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from marketloom.functions import csv_line, csv_line_of, csv_record, utf8_text
from marketloom.functions.csvtext import regular_cells
from marketloom.operators.wire import (
    encode_records,
    judged_records,
    parse_messages,
    project_fields,
    rejected_records,
)
from marketloom.schema import BATCH_COLUMNS

PIECES = ["a", '"', ",", "\n", "\r", " ", '""', ',"', '",', "\\", "#", "'", "\x01", "\x02", "p", "e", "é"]


def parsed_by_python(line):
    try:
        return next(csv.reader(io.StringIO(line, newline="\n")))
    except StopIteration:
        return "empty"
    except csv.Error:
        return "parse"


def random_lines(count, seed):
    rng = random.Random(seed)
    lines = set()
    while len(lines) < count:
        lines.add("".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12))))
    return sorted(lines)


def test_records_split_as_python_splits_them(spark):
    lines = random_lines(8_000, seed=11)
    rows = spark.createDataFrame([(line,) for line in lines], "text string")
    record = csv_record(F.col("text"))
    for row in rows.select("text", record.alias("r")).collect():
        assert (row.r.failure or row.r.fields) == parsed_by_python(row.text), repr(row.text)


def test_messages_split_as_python_splits_them(spark):
    lines = random_lines(3_000, seed=12)
    rows = spark.createDataFrame([(line.encode(),) for line in lines], "value binary")
    for row in parse_messages(rows, arity=2).collect():
        want = parsed_by_python(row.text)
        if isinstance(want, str):
            assert row.reason == want
        else:
            assert row.reason == (None if len(want) == 2 else "arity"), repr(row.text)
            assert row.fields == want


def test_lines_are_written_as_python_writes_them(spark):
    rng = random.Random(13)
    pieces = ["a", '"', ",", "\n", "\r", " ", "#", "\\", "'", "\x0b", "\xa0", " ", ""]
    rows = [
        tuple("".join(rng.choice(pieces) for _ in range(rng.randint(0, 5))) for _ in range(3))
        for _ in range(3_000)
    ]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    cells = [F.col(c) for c in "abc"]
    for row in df.select("*", csv_line(cells).alias("x"), csv_line_of(F.array(*cells)).alias("y")).collect():
        out = io.StringIO()
        csv.writer(out).writerow([row.a, row.b, row.c])
        assert row.x == row.y == out.getvalue().strip()


@pytest.mark.parametrize(
    ("line", "fields", "reason"),
    [
        ("a,b,c", ["a", "b", "c"], None),
        ("a,b", ["a", "b"], "arity"),
        ("a,b,c,d", ["a", "b", "c", "d"], "arity"),
        ('"x, ""y""",b,c', ['x, "y"', "b", "c"], None),
        ('"p\nq",b,c', ["p\nq", "b", "c"], None),
        ("", [""], "empty"),
        ("a\rb,c,d", ["a"], "parse"),
    ],
)
def test_edge_lines(spark, line, fields, reason):
    row = parse_messages(spark.createDataFrame([(line.encode(),)], "value binary"), 3).first()
    assert (row.fields, row.reason) == (fields, reason)


def test_field_limit_is_an_option(spark):
    lines = [f"a,{'x' * 200_000}", f'a,"{"é" * 200_001}"', f'a,"{"é" * 200_001}']
    rows = spark.createDataFrame([(line, line.encode()) for line in lines], "text string, value binary")
    for limit, want in ((None, [None] * 3), (200_000, [None, "parse", "parse"])):
        got = [r.r.failure for r in rows.select(csv_record(F.col("text"), limit).alias("r")).collect()]
        assert got == want
        parsed = parse_messages(rows, 2, field_limit=limit).collect()
        assert [r.reason for r in parsed] == want and [len(r.fields[1]) for r in parsed] == [200_000, 200_001, 200_001]


def test_regular_records_take_the_engine_parser(spark):
    """Records as a CSV writer makes them, of any content but carriage returns."""
    rng = random.Random(5)
    pieces = ["a", '"', ",", "\n", " ", "#", "\\", "'", "\x01", "\x02", "é", "\x00", "\ufeff", ""]
    rows = [["".join(rng.choice(pieces) for _ in range(rng.randint(0, 5))) for _ in range(3)] for _ in range(3_000)]
    lines = []
    for row in rows:
        out = io.StringIO()
        csv.writer(out, lineterminator="").writerow(row)
        lines.append((out.getvalue(), row))
    df = spark.createDataFrame(lines, "text string, want array<string>")
    df = df.select("want", "text", F.encode("text", "UTF-8").alias("value"), regular_cells(F.col("text"), 3).alias("cells"))
    for r in parse_messages(df, 3).collect():
        if r.text:
            assert r.fields == r.want and r.reason is None, repr(r.text)
            regular = '"' in r.text and "\x00" not in r.text and not r.text.startswith("\ufeff")
            assert (r.cells is not None) == regular, repr(r.text)


def test_many_quotes_do_not_recurse(spark):
    text = '"' + 'x""y,' * 20_000 + '",b'
    row = spark.createDataFrame([(text,)], "t string").select(csv_record(F.col("t")).alias("r")).first()
    assert row.r.fields == ["x\"y," * 20_000, "b"]


def test_bad_bytes_are_rejected_and_nothing_is_lost(spark):
    values = [b"ok,1", b"\xff,1", None, b"", b"short", "é,ü".encode()]
    rows = spark.createDataFrame(list(enumerate(values)), "offset long, value binary")
    judged = judged_records(parse_messages(rows, arity=2), ["offset"], {"left": 0, "right": 1})
    rejected = {r.offset: r for r in rejected_records(judged, ["offset"]).collect()}
    assert {k: r.reason for k, r in rejected.items()} == {
        1: "encoding", 2: "encoding", 3: "empty", 4: "arity",
    }
    assert rejected[4].field_count == 1 and rejected[4].preview == "short"
    accepted = project_fields(parse_messages(rows, 2), ["offset"], {"right": 1, "left": 0})
    assert [tuple(r) for r in accepted.orderBy("offset").collect()] == [(0, "1", "ok"), (5, "ü", "é")]
    assert judged.count() == len(values)


def test_preview_is_the_first_hundred_characters(spark):
    rows = spark.createDataFrame([(("é" * 300).encode(),)], "value binary")
    judged = judged_records(parse_messages(rows))
    assert rejected_records(judged).first().preview == "é" * 100


def test_positions_of_the_projection(spark):
    record = spark.range(1).select(*[F.lit(f"v{i}").alias(f"c{i}") for i in range(24)])
    row = project_fields(parse_messages(encode_records(record, record.columns))).first()
    assert list(row) == ["v0", "v2", "v3", "v4", "v11", "v5", "v8", "v9", "v18", "v17", "v12"]
    assert row.__fields__ == BATCH_COLUMNS


def test_utf8(spark):
    rows = spark.createDataFrame([(b"\xc3\xa9",), (b"\xc3",)], "v binary")
    assert [r[0] for r in rows.select(utf8_text(F.col("v"))).collect()] == ["é", None]


def test_filters_do_not_repeat_the_parse(spark):
    rows = spark.createDataFrame([(b"a,b",)], "value binary")
    plan = project_fields(parse_messages(rows, 2), [], {"a": 0})._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("regexp_extract_all") == 1
