"""Session settings and the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_STAGED: list[str] = []
_BLOCKS = threading.local()


def local_session(cores: int | str = "*", app_name: str = "marketloom", **conf) -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names.

    Only a local session may fall back to the machine's own temporary folder:
    one folder for the process, removed when it ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="marketloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _held() -> list[str]:
    """What the innermost ``staging`` block of this thread has staged; without one, what the process has."""
    blocks = getattr(_BLOCKS, "open", None)
    return blocks[-1] if blocks else _STAGED


def staged(df: DataFrame, purpose: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Costly upstream work then runs once, and a lost executor re-reads files
    instead of repeating it. ``release`` removes the files at the end of a job.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    _held().append(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` from a checkpoint in the shared folder: the same rows in the same partitions, without the steps before.

    Each task reports every metric of all steps behind it to the driver; for a
    table that many small tasks run over again and again, this keeps the reports
    short. The files go with those that ``staged`` writes.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoints"))
    cut = df.checkpoint()
    _held().append(cut._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get())
    return cut


def hand_over(paths: Sequence[str]) -> None:
    """Let folders that were written otherwise go with those that ``staged`` writes."""
    _held().extend(paths)


def release(spark: SparkSession) -> None:
    """Remove what ``staged`` has written in this process outside of ``staging`` blocks.

    Results that still read it must be stored before.
    """
    remove_paths(spark, _STAGED)


def remove_paths(spark: SparkSession, paths: list[str]) -> None:
    """Remove folders in any store that Spark reads, and take them off the list."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(hadoop).delete(path, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove at its end what this thread staged inside; for work whose output is stored by then.

    Blocks may be nested, and threads may have blocks of their own at the same time.
    """
    if not hasattr(_BLOCKS, "open"):
        _BLOCKS.open = []
    _BLOCKS.open.append([])
    try:
        yield
    finally:
        remove_paths(spark, _BLOCKS.open.pop())
