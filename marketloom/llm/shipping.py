"""What Python tasks need: this package, as ``--py-files`` would send it, and batches that fit a worker."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

import marketloom

ARCHIVE = "marketloom-code"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Documents handed to a worker at a time, unless the session sets a number of its own.
BATCH_DOCUMENTS = 500


def ship_code(spark: SparkSession) -> None:
    """Let tasks import this package, wherever the driver has it from; once for each application.

    Also lowers the rows of an Arrow batch, as texts are long: both ends of the
    pipe to a worker hold a whole batch outside the heap.
    """
    context = spark.sparkContext
    if BATCH not in dict(context.getConf().getAll()) and int(spark.conf.get(BATCH)) == 10_000:
        spark.conf.set(BATCH, BATCH_DOCUMENTS)
    if any(name.startswith(ARCHIVE) for name in context._python_includes):
        return
    package = Path(marketloom.__file__).parent
    folder = tempfile.mkdtemp(prefix=ARCHIVE)  # executors fetch the archive from the driver as they start
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sources = Path(folder, "sources")
    shutil.copytree(package, sources / package.name, ignore=shutil.ignore_patterns("__pycache__"))
    name = f"{ARCHIVE}-{context.applicationId}"
    context.addPyFile(shutil.make_archive(str(Path(folder, name)), "zip", sources))
