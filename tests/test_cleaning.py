import math

import pytest

from marketloom.operators import cleaning
from marketloom.schema import FEATURES

# Rating, Installs, Size and Price as text, each with its number before filling.
EDGE_ROWS = [
    ("4.5", 4.5, "1,000+", 1000.0, "10M", 10.0, "$1.99", 1.99),
    (None, None, "5,000+", 5000.0, "512k", 0.5, "0", 0.0),
    ("NaN", math.nan, "0+", 0.0, "Varies with device", None, "Free", None),
    ("3.0", 3.0, "10", 10.0, "1.5G", None, "$", None),
    ("2.0", 2.0, None, None, "1,018k", None, "USD 3", None),
    ("bad", None, "1 000+", None, "M", None, "$1,000.00", None),
    (" 4.0 ", 4.0, "+5", 5.0, "10m", None, " 2.5 ", 2.5),
    ("1e1", 10.0, "1,0,0", 100.0, "25", None, "-1", -1.0),
    ("5", 5.0, "500,000+", 500000.0, "0M", 0.0, "$$2", 2.0),
    ("5", 5.0, "1+1", 11.0, "2MM", 2.0, None, None),
    ("5", 5.0, "7", 7.0, "10M ", None, "1", 1.0),
]


def text_rows(spark):
    rows = [
        (i, r[0], "3", r[4], r[2], r[6], None if i % 3 else "GAME")
        for i, r in enumerate(EDGE_ROWS)
    ]
    schema = "id int, Rating string, Reviews string, Size string, Installs string, Price string, Category string"
    return spark.createDataFrame(rows, schema)


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def test_edge_rows(spark):
    rows = cleaning.clean_features(text_rows(spark)).orderBy("id").collect()
    for row, want in zip(rows, EDGE_ROWS, strict=True):
        got = (row.Rating, row.Installs, row.Size, row.Price)
        assert all(map(same, got, (want[1], want[3], want[5], want[7]))), (want, got)


def test_fill_with_nan_as_missing(spark):
    cleaned = cleaning.clean_features(text_rows(spark))
    rows = cleaning.fill_missing(cleaned).orderBy("id").collect()
    real = [r[1] for r in EDGE_ROWS if r[1] is not None and not math.isnan(r[1])]
    mean = sum(real) / len(real)
    for row, want in zip(rows, EDGE_ROWS, strict=True):
        known = want[1] is not None and not math.isnan(want[1])
        assert row.Rating == pytest.approx(want[1] if known else mean)
        assert (row.Installs, row.Size, row.Price) == (want[3] or 0, want[5] or 0, want[7] or 0)
        assert row.Category == ("Unknown" if row.id % 3 else "GAME")
    assert cleaning.prepare(text_rows(spark)).count() == len(EDGE_ROWS)


def test_propagated_nan_drops_what_needed_the_mean(spark):
    kept = cleaning.prepare(text_rows(spark), nan="propagate")
    unrated = {i for i, r in enumerate(EDGE_ROWS) if r[1] is None or math.isnan(r[1])}
    assert {r.id for r in kept.collect()} == set(range(len(EDGE_ROWS))) - unrated


def test_policies_agree_without_nan(spark):
    rows = text_rows(spark).filter("Rating IS NULL OR Rating <> 'NaN'")
    a = cleaning.prepare(rows).orderBy("id").collect()
    assert a == cleaning.prepare(rows, nan="propagate").orderBy("id").collect()


def test_mean_without_any_rating_is_zero(spark):
    rows = cleaning.clean_features(text_rows(spark)).filter("Rating IS NULL")
    assert cleaning.mean_fill_value(rows).first().fill == 0.0
    assert {r.Rating for r in cleaning.fill_missing(rows).collect()} == {0.0}


def test_given_mean(spark):
    rows = cleaning.clean_features(text_rows(spark))
    assert cleaning.fill_missing(rows, 1.25).filter("id = 1").first().Rating == 1.25


def test_unknown_policy(spark):
    with pytest.raises(ValueError, match="policy"):
        cleaning.mean_fill_value(cleaning.clean_features(text_rows(spark)), nan="other")


def test_snapshot_statistics(spark):
    rows = [(1, 2.0), (1, None), (2, 4.0), (3, 9.0), (3, math.nan)]
    df = spark.createDataFrame(rows, "tier int, Rating double")
    got = cleaning.snapshot_statistics(df).first()
    assert (got.fill_1, got.fill_2, got.fill_3) == (2.0, 3.0, 5.0)
    assert (got.rows_1, got.rows_2, got.rows_3) == (2, 3, 5)
    assert (got.kept_1, got.kept_2, got.kept_3) == (2, 3, 5)
    got = cleaning.snapshot_statistics(df, nan="propagate").first()
    assert math.isnan(got.fill_3) and (got.kept_2, got.kept_3) == (3, 3)


def test_profile(spark):
    row = cleaning.profile(cleaning.clean_features(text_rows(spark))).first()
    assert row.row_count == len(EDGE_ROWS)
    assert row.missing_rating == 3 and row.missing_price == 5
    assert row.missing_category == sum(1 for i in range(len(EDGE_ROWS)) if i % 3)
    complete = cleaning.drop_incomplete(cleaning.clean_features(text_rows(spark)))
    assert row.complete_rows == complete.count()


def test_schema_listing(spark):
    listing = cleaning.schema_listing(cleaning.clean_features(text_rows(spark)))
    assert {listing[c] for c in FEATURES} == {"double"}
