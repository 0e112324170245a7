import pytest

from marketloom.llm import licenses
from marketloom.llm.licenses import UNKNOWN, license_paragraphs, sample_paragraphs, train
from tests.llm import edge

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return train(sample_paragraphs(spark.read.parquet(f"{FOLDER}/documents.parquet"), size=800))


def families(model, text):
    return [(f["paragraph"], f["family"]) for f in licenses._document(text, model)[1]]


def test_statements(model):
    assert families(model, "Some words.\n\nReleased under the MIT License.\nLicensed under the Apache License, Version 2.0.") == [
        (1, "mit"),
        (2, "apache-2.0"),
    ]
    assert families(model, "This work is licensed under the GNU General Public License, version 3.") == [(0, "gpl")]
    assert families(model, "Licensed under CC BY-NC 4.0.") == [(0, "cc-by-nc")]
    assert families(model, "Licensed under CC BY-SA 4.0.") == [(0, "cc-by-sa")]
    long = "plain words go on and on here. " * 40
    assert families(model, long + "Licensed under the Apache License, Version 2.0. " + long) == [(0, "apache-2.0")]


def test_unknown_and_ordinary_text(model):
    assert families(model, "This book is licensed under the terms of the Foo Bar commercial license agreement.") == [(0, UNKNOWN)]
    assert families(model, "The driver showed a card.\nWe went under the bridge, version of events unknown.") == []


def test_held_out_variants(model):
    """Statements that were not trained on, among words that were not either."""
    import random

    rng = random.Random(99)
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    right = total = 0
    for name, texts in licenses.TEMPLATES.items():
        for text in texts:
            for _ in range(5):
                tokens = licenses._varied(rng, text, words)
                found = licenses._document(" ".join(tokens), model)[1]
                total += 1
                right += bool(found) and found[0]["family"] in (name, UNKNOWN)
    assert right / total > 0.95


def test_whole_table_against_the_statements_in_it(spark, model):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    statements = {
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "Released under the MIT License.": "mit",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    }
    for r in license_paragraphs(docs, model).collect():
        paragraphs = [p for p in r.text.split("\n") if p.strip()]
        want = [(i, statements[p]) for i, p in enumerate(paragraphs) if p in statements]
        assert [(f.paragraph, f.family) for f in r.licenses if f.family != UNKNOWN] == want
        assert r.n_paragraphs == len(paragraphs)


def test_edge_rows(spark, model):
    rows = license_paragraphs(edge.clashing(spark, "licenses", "n"), model).collect()
    assert len(rows) == len(edge.ROWS) and all(r.licenses == [] for r in rows) and {r["n"] for r in rows} == {"mine"}
    assert license_paragraphs(edge.empty(spark), model).count() == 0
    assert sample_paragraphs(edge.empty(spark)) == []


def test_no_ordinary_sample():
    assert families(train([]), "Released under the MIT License.") == [(0, "mit")]


ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""


def test_statements_over_several_lines(model):
    assert families(model, ISC) == [(0, "isc")]
    notice = "Some words before.\n\n" + "\n".join(" * " + line for line in ISC.split("\n")) + "\n\nOther words."
    assert families(model, notice) == [(1, "isc")]
    assert families(model, "Licensed under the Apache\nLicense, Version\n2.0.") == [(0, "apache-2.0")]
    lesser = "This work is licensed under the GNU\nLesser General Public License,\nversion 3."
    assert families(model, lesser) == [(0, "lgpl")]
    apart = "Permission to use, copy, modify, and/or\n\ndistribute this software for any purpose"
    assert "isc" not in [family for _, family in families(model, apart)]


def test_all_families_of_a_paragraph(model):
    plain = "plain words go on and on here. " * 20
    text = plain + "Released under the MIT License. " + plain + "Licensed under the Apache License, Version 2.0. " + plain
    assert families(model, text) == [(0, "mit"), (0, "apache-2.0")]
    dual = "Released under the MIT License or licensed under the Apache License, Version 2.0."
    assert sorted(families(model, dual)) == [(0, "apache-2.0"), (0, "mit")]
    assert families(model, "Licensed under the GNU Lesser General Public License, version 3.") == [(0, "lgpl")]
    notice = "You can redistribute it and/or modify it under the terms of the GNU General Public License."
    assert families(model, notice) == [(0, "gpl")]
