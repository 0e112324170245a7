import csv
import random

import pytest
from pyspark.sql import functions as F

from marketloom.operators import batching, snapshots
from marketloom.schema import BATCH_COLUMNS
from marketloom.sources import batches


def messages(spark, seed, partitions=3, count=2_000, hot=0.7):
    """Offsets with gaps; one partition holds most of them."""
    rng = random.Random(seed)
    rows = []
    for p in range(partitions):
        offset, n = rng.randint(0, 500), int(count * (hot if p == 1 else (1 - hot) / 2))
        for _ in range(n):
            offset += rng.choice([1, 1, 1, 2, 90])
            rows.append((p, offset))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bucket", [7, 64, 1 << 20])
def test_numbers_follow_partition_and_offset(spark, monkeypatch, bucket):
    monkeypatch.setattr(batching, "BUCKETS_PER_SPAN", 8)
    rows = messages(spark, seed=bucket)
    df = spark.createDataFrame(rows, "partition int, offset long").repartition(5)
    got = batching.number_batches(df, 100, start=250, bucket_offsets=bucket).collect()
    want = {key: 251 + i for i, key in enumerate(sorted(rows))}
    assert {(r.partition, r.offset): r.row_no for r in got} == want
    assert all(r.batch_no == (r.row_no - 1) // 100 + 1 for r in got)


def test_large_numbers_stay_exact(spark):
    big = (1 << 62) + 3
    df = spark.createDataFrame([(0, big), (0, big + 1), (0, big - 1)], "partition int, offset long")
    got = batching.number_batches(df, 1, bucket_offsets=2).orderBy("offset").collect()
    assert [r.row_no for r in got] == [1, 2, 3]
    no = spark.range(1).select(batching.batch_number(F.lit(big), 3).alias("n")).first().n
    assert no == (big - 1) // 3 + 1


def test_rows_are_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).select(
            (F.col("id") % 3).cast("int").alias("partition"),
            F.col("id").alias("offset"),
            F.col("id").cast("string").alias("payload"),
        )
        numbered = batching.number_batches(df, 10)
        numbered.collect()
        plan = numbered._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan.split("== Initial Plan ==")[0]
    # One shuffle for the rows, one for the bucket counts, which two branches share.
    assert final.count("Range (0, 1000") == 2
    assert "ReusedExchange" in final
    rows = [line for line in final.splitlines() if "Exchange hashpartitioning" in line]
    assert rows[0].strip(" +-:").startswith("Exchange hashpartitioning(partition")


def test_remainder(spark):
    df = spark.range(25).select(F.lit(0).alias("partition"), F.col("id").alias("offset"))
    for size, want in ((10, {3}), (5, set()), (100, {1})):
        numbered = batching.number_batches(df, size)
        last = numbered.filter(batching.is_remainder(F.col("batch_no"), 25, size))
        assert {r.batch_no for r in last.collect()} == want


def names(spark, values):
    return spark.createDataFrame([(v,) for v in values], "file_name string").repartition(4)


def test_batch_orders(spark):
    listed = [f"batch_{n}_2024010100{n % 60:02d}00.csv" for n in range(1, 130)]
    listed += ["batch_1_20250101000000.csv", "batch_130_20240101000000_remaining.csv"]
    by_text = snapshots.rank_batches(names(spark, listed), "lexical").collect()
    assert [r.file_name for r in sorted(by_text, key=lambda r: r.batch_rank)] == sorted(listed)
    by_number = snapshots.rank_batches(names(spark, listed), "numeric").collect()
    key = {v: (int(v.split("_")[1]), v.split("_")[2]) for v in listed}
    assert [r.file_name for r in sorted(by_number, key=lambda r: r.batch_rank)] == sorted(
        listed, key=key.get
    )
    remaining = {r.file_name for r in by_number if r.is_remainder}
    assert remaining == {"batch_130_20240101000000_remaining.csv"}
    assert snapshots.first_batches(names(spark, listed), "lexical") == sorted(listed)[:3]
    assert snapshots.first_batches(names(spark, listed)) == sorted(listed, key=key.get)[:3]


def test_unknown_order(spark):
    with pytest.raises(ValueError, match="order"):
        snapshots.first_batches(names(spark, ["batch_1_2.csv"]), "random")


def test_batch_file_names(spark):
    written = F.lit("2024-02-03 04:05:06").cast("timestamp")
    row = spark.range(1).select(
        snapshots.batch_file_name(F.lit(7), written).alias("full"),
        snapshots.batch_file_name(F.lit(8), written, F.lit(True)).alias("partial"),
    ).first()
    assert row.full == "batch_7_20240203040506.csv"
    assert row.partial == "batch_8_20240203040506_remaining.csv"


def test_snapshots_nest(spark):
    df = spark.range(1, 51).select("id", ((F.col("id") - 1) / 10).cast("int").alias("b"))
    tiered = df.withColumn("tier", snapshots.tier_of_rank(F.col("b") + 1))
    got = snapshots.cumulative_snapshots(tiered)
    counts = {r.snapshot: r["count"] for r in got.groupBy("snapshot").count().collect()}
    assert counts == {"model1": 10, "model2": 20, "model3": 50}
    for name, size in counts.items():
        assert snapshots.snapshot(tiered, name).count() == size


def test_store_prunes_to_the_first_batches(spark, tmp_path):
    df = spark.range(5_000).select(F.lit(0).alias("partition"), F.col("id").alias("offset"))
    batches.write_batch_store(batching.number_batches(df, 2), str(tmp_path / "store"))
    store = batches.read_batch_store(spark, str(tmp_path / "store"))
    first = batches.up_to_batch(store, 2)
    assert sorted(r.offset for r in first.collect()) == [0, 1, 2, 3]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "batch_span" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "LessThanOrEqual(batch_no,2)" in plan


def test_batch_files_suit_python_and_spark(spark, tmp_path):
    nasty = [" lead", "trail ", 'q"uote', '"', "a,b", "x\ny", "x\r\ny", "#hash", "\\", "é", "a\rb", None]
    rows = [
        (i + 1, i // 4 + 1, *[nasty[(i + j) % len(nasty)] for j in range(len(BATCH_COLUMNS))])
        for i in range(len(nasty))
    ]
    numbered = spark.createDataFrame(rows, ["row_no", "batch_no", *BATCH_COLUMNS])
    path = str(tmp_path / "files")
    written = F.lit("2024-02-03 04:05:06").cast("timestamp")
    batches.write_batch_files(numbered, path, written, F.col("batch_no") == 3)
    assert sorted(r.file_name for r in batches.list_batch_files(spark, path).collect()) == [
        "batch_1_20240203040506.csv",
        "batch_2_20240203040506.csv",
        "batch_3_20240203040506_remaining.csv",
    ]
    by_batch = {}
    for folder in sorted((tmp_path / "files").glob("batch_span=*/batch_file=*")):
        parts = list(folder.glob("part-*.csv"))
        assert len(parts) == 1
        with parts[0].open(newline="", encoding="utf-8") as lines:
            header, *found = csv.reader(lines)
        assert header == BATCH_COLUMNS
        by_batch[folder.name] = found
    assert [r for name in sorted(by_batch) for r in by_batch[name]] == [
        [v or "" for v in row[2:]] for row in rows
    ]
    again = batches.read_batch_files(spark, path).select(*[f"`{c}`" for c in BATCH_COLUMNS])
    assert sorted(map(str, map(tuple, again.collect()))) == sorted(str(row[2:]) for row in rows)
