from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from threading import Barrier
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from marketloom import session


def fake(master, folder):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder),
        sparkContext=SimpleNamespace(master=master),
    )


def test_the_shared_folder_comes_from_the_session():
    path = session.shared_dir(fake("yarn", "hdfs://nn/shared/"), "x")
    assert path.startswith("hdfs://nn/shared/x-")
    assert path != session.shared_dir(fake("yarn", "hdfs://nn/shared/"), "x")


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(fake("yarn", None), "x")
    assert "/x-" in session.shared_dir(fake("local[2]", None), "x")


def test_staged_tables_keep_rows_and_types(spark):
    df = spark.createDataFrame([(1, ["a"], None)], "a int, b array<string>, c double")
    again = session.staged(df, "t")
    assert again.collect() == df.collect() and again.dtypes == df.dtypes


def test_staged_tables_are_removed_at_the_end(spark):
    df = session.staged(spark.range(3).withColumn("half", F.col("id") % 2), "gone", ["half"])
    path = df.inputFiles()[0].removeprefix("file://").rsplit("/", 2)[0]
    assert df.count() == 3 and Path(path).is_dir()
    with session.staging(spark):
        inner = session.staged(spark.range(3), "inner").inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert Path(path).is_dir() and not Path(inner).exists()
    session.release(spark)
    assert not Path(path).exists()


def test_threads_remove_their_own_tables(spark):
    def folder(df):
        return Path(df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0])

    def work(_):
        with session.staging(spark):
            outer = folder(session.staged(spark.range(2), "outer"))
            with session.staging(spark):
                inner = folder(session.staged(spark.range(2), "inner"))
            barrier.wait(60)  # all tables are written before any thread ends its block
            return outer.exists(), inner.exists(), outer

    barrier = Barrier(3)
    with ThreadPoolExecutor(3) as pool:
        found = list(pool.map(work, range(3)))
    assert [(a, b) for a, b, _ in found] == [(True, False)] * 3
    assert not any(path.exists() for *_, path in found)
