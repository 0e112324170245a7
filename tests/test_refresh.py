"""Summaries of micro-batches beside what a pass over the whole history gives."""

import math

import pytest
from pyspark.sql import functions as F

from marketloom.operators.snapshots import cumulative_snapshots, tier_of_rank
from marketloom.operators.wire import encode_records
from marketloom.plans import refresh
from marketloom.plans.serving import Scorer
from marketloom.schema import FEATURES, SNAPSHOTS
from marketloom.sources.topic import as_messages
from marketloom.streaming import ingest

NAMES = ["App", "Category", *FEATURES]


def app(i):
    rating = ["4.5", "", "NaN", "3.0", "bad"][i % 5]
    return (i, f"app {i}", ["GAME", "TOOLS", "", "NEWS"][i % 4], rating, str(10**9 + i), f"{i % 30}M", f"{i % 50},000+", f"${i % 7}")


@pytest.fixture
def store(tmp_path):
    return ingest.IngestStore(str(tmp_path / "out"))


def deliver(spark, store, micro, first, last):
    rows = spark.createDataFrame([app(i) for i in range(first, last)], ["id", *NAMES])
    messages = as_messages(encode_records(rows, NAMES, keep=["id"]), "apps", "id")
    positions = {name: i for i, name in enumerate(NAMES)}
    store.write_settings(spark, 100, positions)
    ingest.ingest_micro_batch(messages, micro, store, 100, len(NAMES), positions)


def number(text):
    try:
        value = float(text.strip("$M+").replace(",000", "000"))
    except ValueError:
        return None
    return None if math.isnan(value) else value


def expected(last):
    found = {}
    for name, limit in zip(SNAPSHOTS, (100, 200, last), strict=True):
        for place, feature in enumerate(FEATURES):
            column = {"Rating": 3, "Reviews": 4, "Size": 5, "Installs": 6, "Price": 7}[feature]
            values = [number(app(i)[column]) for i in range(limit)]
            real = [v for v in values if v is not None]
            fill = sum(real) / len(real) if feature == "Rating" else 0.0
            filled = [fill if v is None else v for v in values]
            mean = sum(filled) / len(filled)
            deviation = math.sqrt(sum((v - mean) ** 2 for v in filled) / (len(filled) - 1))
            found[name, feature] = (limit, limit - len(real), fill, mean, deviation)
    return found


def got(spark, summaries):
    rows = summaries.statistics(spark).collect()
    return {(r.snapshot, r.feature): (r.row_count, r.missing, r.fill, r.mean, r.deviation) for r in rows}


def itemsets(summaries, spark):
    return {(r.snapshot, r["items"][0]): r.freq for r in summaries.itemsets(spark).collect()}


def expected_itemsets(last):
    found = {}
    for name, limit in zip(SNAPSHOTS, (100, 200, last), strict=True):
        for i in range(limit):
            key = name, app(i)[2] or "Unknown"
            found[key] = found.get(key, 0) + 1
    return found


def test_refreshes_add_up(spark, store):
    """Batches that two deliveries share, a refresh with nothing new, and one over two deliveries."""
    summaries, done = refresh.Summaries(store), []
    assert summaries.refresh(spark) == (0, -1)
    for micro, (first, last) in enumerate([(0, 130), (130, 290), (290, 310), (310, 450)]):
        deliver(spark, store, micro, first, last)
        if micro != 2:
            done.append(summaries.refresh(spark))
    assert done == [(0, 0), (1, 1), (2, 3)] and summaries.refresh(spark) == (4, 3)
    assert itemsets(summaries, spark) == expected_itemsets(450)
    figures = expected(450)
    for key, values in got(spark, summaries).items():
        assert values == pytest.approx(figures.pop(key), rel=1e-9, abs=1e-9)
    assert not figures


def test_only_new_micro_batches_are_read(spark, store, tmp_path):
    summaries = refresh.Summaries(store)
    deliver(spark, store, 0, 0, 320)
    summaries.refresh(spark)
    for part in (tmp_path / "out/batches/micro=0").rglob("*.parquet"):
        part.write_bytes(b"no longer readable")
    deliver(spark, store, 1, 320, 400)
    assert summaries.refresh(spark) == (1, 1)
    assert itemsets(summaries, spark) == expected_itemsets(400)


def test_a_refresh_over_a_compaction(spark, store):
    summaries = refresh.Summaries(store)
    deliver(spark, store, 0, 0, 150)
    summaries.refresh(spark)
    deliver(spark, store, 1, 150, 330)
    ingest.compact_in_place(spark, store, vacuum=True)
    assert summaries.refresh(spark) == (1, 1)
    assert itemsets(summaries, spark) == expected_itemsets(330)


def test_a_refresh_that_breaks_off_counts_nothing(spark, store, monkeypatch):
    summaries = refresh.Summaries(store)
    deliver(spark, store, 0, 0, 350)
    monkeypatch.setattr(refresh, "summarise_items", lambda _: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        summaries.refresh(spark)
    monkeypatch.undo()
    deliver(spark, store, 1, 350, 400)
    assert summaries.refresh(spark) == (0, 1)
    assert itemsets(summaries, spark) == expected_itemsets(400)
    assert got(spark, summaries)["model3", "Size"][0] == 400


def test_refreshed_itemsets_are_served(spark, store, tmp_path):
    models = str(tmp_path / "models")
    deliver(spark, store, 0, 0, 150)
    with pytest.raises(ValueError, match="2 batches found"):
        refresh.refresh_itemsets(spark, store, models)
    deliver(spark, store, 1, 150, 333)
    assert len(refresh.refresh_itemsets(spark, store, models)) == 3
    scorer = Scorer(spark, models)
    served = {(name, r["items"][0]): r.freq for name in SNAPSHOTS for r in scorer.itemsets(name).collect()}
    assert served == expected_itemsets(333)


def test_features_without_values(spark):
    held = spark.createDataFrame([(1, None, None, None, None, None, None)] * 3, "batch_no long, " + ", ".join(f"{c} double" for c in FEATURES) + ", Category string")
    rows = refresh.summarise_features(held).collect()
    assert [(r.row_count, r.present, r.mean) for r in rows] == [(3, 0, None)] * 5
    assert [tuple(r) for r in refresh.summarise_items(held).collect()] == [(1, "Unknown", 3)]


def test_late_rows_keep_their_numbers(spark, tmp_path):
    """Numbers follow the micro-batches; how late a row is follows from what came before it."""
    store = ingest.IngestStore(str(tmp_path))
    store.write_settings(spark, 10, {"App": 0})
    deliveries = [[50, 10], [20, 60, 50], [], [55, 61]]
    for micro, seconds in enumerate(deliveries):
        rows = spark.createDataFrame([(micro * 10 + i, s) for i, s in enumerate(seconds)], "id long, s long")
        messages = as_messages(rows.select("id", F.timestamp_seconds("s").alias("at"), F.lit(b"x").alias("value")), "t", "id", timestamp="at")
        ingest.ingest_micro_batch(messages, micro, store, 10, 1, {"App": 0})
        if micro == 1:
            ingest.compact_in_place(spark, store, vacuum=True)
    found = [(r.offset, r.lateness) for r in store.read_arrivals(spark).orderBy("row_no").collect()]
    assert found == [(1, None), (0, None), (10, 30.0), (12, None), (11, None), (30, 5.0), (31, None)]


def test_snapshots_of_a_summary_hold_earlier_batches(spark):
    df = spark.range(1, 6).withColumn("tier", tier_of_rank(F.col("id")))
    counts = {r.snapshot: r["count"] for r in cumulative_snapshots(df).groupBy("snapshot").count().collect()}
    assert counts == {"model1": 1, "model2": 2, "model3": 5}
