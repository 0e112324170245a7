"""Topic to batch store as a stream, with exactly-once output.

Every micro-batch writes its rows below ``micro=<id>`` and then its row count to
the ledger. A retry overwrites the same directories with the same rows, because
its starting row number comes from the ledger entry before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketloom.operators.batching import batch_span, is_remainder, number_in_order
from marketloom.operators.cleaning import observed
from marketloom.operators.wire import (
    accepted_records,
    judged_records,
    parse_messages,
    rejected_records,
)
from marketloom.schema import BATCH_SIZE, WIRE_FIELD_COUNT, WIRE_POSITIONS
from marketloom.session import remove_paths, staged, staging
from marketloom.sources.batches import (
    commit_exported,
    exported_batches,
    read_batch_store,
    write_batch_files,
    write_batch_store,
)

# Arrival: messages of the same moment by topic partition and offset, which together are unique.
ORDER = ["timestamp", "partition", "offset"]
_ORDER_FIELDS = [
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
]
_MICRO = T.StructField("micro", T.IntegerType())
LEDGER_SCHEMA = T.StructType(
    [*[T.StructField(name, T.LongType()) for name in ("rows_before", "valid_rows", "rows_after")], _MICRO]
)
ARRIVAL_SCHEMA = T.StructType([T.StructField("latest", T.LongType()), _MICRO])
REJECT_SCHEMA = T.StructType(
    [
        *_ORDER_FIELDS,
        T.StructField("reason", T.StringType()),
        T.StructField("field_count", T.IntegerType()),
        T.StructField("preview", T.StringType()),
        T.StructField("value", T.BinaryType()),
        _MICRO,
    ]
)


def store_schema(columns: Sequence[str]) -> T.StructType:
    """Rows of the batch store; written down, as a store of rejects alone has no file to tell it."""
    return T.StructType(
        [
            *_ORDER_FIELDS,
            *[T.StructField(name, T.StringType()) for name in columns],
            T.StructField("row_no", T.LongType()),
            T.StructField("batch_no", T.LongType()),
            T.StructField("batch_span", T.LongType()),
            _MICRO,
        ]
    )


def _readable(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


class IngestStore:
    """Paths of one ingest: accepted rows, quarantine and ledger.

    A compaction holds the rows of all micro-batches up to one of them in large
    sorted files. Once it is committed, readers take those rows from there and
    later ones from the micro-batches; the stream goes on as before.
    """

    def __init__(self, base: str):
        self.base = base.rstrip("/")
        self.batches = f"{self.base}/batches"
        self.rejects = f"{self.base}/rejects"
        self.ledger = f"{self.base}/ledger"
        self.arrivals = f"{self.base}/arrivals"
        self.compacted = f"{self.base}/compacted"
        self.compactions = f"{self.base}/compactions"

    def micro(self, table: str, micro_batch: int) -> str:
        return f"{table}/micro={micro_batch}"

    def rows_before(self, spark: SparkSession, micro_batch: int) -> int:
        """Rows accepted by earlier micro-batches: one small read, whatever the history."""
        if micro_batch == 0:
            return 0
        try:
            entry = spark.read.parquet(self.micro(self.ledger, micro_batch - 1)).first()
        except AnalysisException as error:
            raise RuntimeError(
                f"ledger entry {micro_batch - 1} is missing below {self.ledger}: "
                "checkpoint and output do not belong together"
            ) from error
        return entry["rows_after"]

    def require_checkpoint(self, spark: SparkSession, checkpoint: str) -> None:
        """A new checkpoint would count from zero again over the rows that are here."""
        if _readable(spark, self.ledger) and not _readable(spark, f"{checkpoint}/metadata"):
            raise ValueError(f"{self.base} has rows already, but {checkpoint} has no progress")

    def latest_before(self, spark: SparkSession, micro_batch: int) -> int | None:
        """The latest timestamp of earlier micro-batches in microseconds, None if there is none."""
        entry = self._read_latest(spark).filter(F.col("micro") == micro_batch - 1).first()
        return None if entry is None else entry["latest"]

    def _read_latest(self, spark: SparkSession) -> DataFrame:
        if not _readable(spark, self.arrivals):
            return spark.createDataFrame([], ARRIVAL_SCHEMA)
        return spark.read.schema(ARRIVAL_SCHEMA).parquet(self.arrivals)

    def write_latest(self, spark: SparkSession, micro_batch: int, latest: int | None) -> None:
        """Note the latest timestamp up to a micro-batch; like its rows, it counts once the ledger entry is there."""
        row = spark.range(1).select(F.lit(latest).cast("long").alias("latest"))
        row.write.mode("overwrite").parquet(self.micro(self.arrivals, micro_batch))

    def write_ledger(self, spark: SparkSession, micro_batch: int, before: int, rows: int) -> None:
        (
            spark.range(1)
            .select(
                F.lit(before).cast("long").alias("rows_before"),
                F.lit(rows).cast("long").alias("valid_rows"),
                F.lit(before + rows).cast("long").alias("rows_after"),
            )
            .write.mode("overwrite")
            .parquet(self.micro(self.ledger, micro_batch))
        )

    def read_batches(self, spark: SparkSession) -> DataFrame:
        """Committed rows with ``row_no``, ``batch_no`` and ``is_remainder``.

        Rows of a micro-batch that is not in the ledger, as after a crash, are not read.
        """
        known = self.settings(spark)
        last, total = self.committed(spark)
        rows = self._read_up_to(spark, self.batches, store_schema(known["columns"]), last)
        remainder = is_remainder(F.col("batch_no"), total, known["batch_size"])
        return rows.withColumn("is_remainder", remainder)

    def read_arrivals(self, spark: SparkSession) -> DataFrame:
        """``read_batches`` with ``lateness``, in seconds behind the latest message of earlier micro-batches.

        Rows are numbered by micro-batch first and by time within it, once and for
        all: a message that comes late follows those that came before, whatever
        their timestamps, and no number ever changes. NULL for rows in time.
        """
        entries = self._read_latest(spark).select((F.col("micro") + 1).alias("micro"), "latest")
        behind = (F.col("latest") - F.unix_micros("timestamp")) / 1e6
        rows = self.read_batches(spark).join(entries, "micro", "left")
        return rows.withColumn("lateness", F.when(behind > 0, behind)).drop("latest")

    def committed(self, spark: SparkSession) -> tuple[int, int]:
        """The last micro-batch in the ledger, -1 if there is none, and the rows up to it."""
        last = self.read_ledger(spark).agg(F.max(F.struct("micro", "rows_after")).alias("m")).first()["m"]
        return (-1, 0) if last is None else (last["micro"], last["rows_after"])

    def settings(self, spark: SparkSession):
        return spark.read.parquet(f"{self.base}/settings").first()

    def write_settings(
        self, spark: SparkSession, batch_size: int, positions: Mapping[str, int] | None = None
    ) -> None:
        """Batch size and columns are fixed by the first run; a later run must use the same."""
        columns = list(WIRE_POSITIONS if positions is None else positions)
        try:
            known = self.settings(spark)
        except AnalysisException:
            row = spark.range(1).select(
                F.lit(batch_size).alias("batch_size"), F.array(*map(F.lit, columns)).alias("columns")
            )
            row.write.mode("overwrite").parquet(f"{self.base}/settings")
            return
        if known["batch_size"] != batch_size:
            raise ValueError(f"this store has batches of {known['batch_size']} rows, not {batch_size}")
        if known["columns"] != columns:
            raise ValueError(f"this store has the columns {known['columns']}, not {columns}")

    def read_rejects(self, spark: SparkSession) -> DataFrame:
        """Committed quarantine rows."""
        last, _ = self.committed(spark)
        return self._read_up_to(spark, self.rejects, REJECT_SCHEMA, last)

    def _read_up_to(self, spark: SparkSession, table: str, schema: T.StructType, last: int) -> DataFrame:
        rows = read_batch_store(spark, table, schema).filter(F.col("micro") <= last)
        compacted = self.compacted_up_to(spark)
        if compacted < 0:
            return rows
        large = read_batch_store(spark, self.compaction(table, compacted), schema)
        return rows.filter(F.col("micro") > compacted).unionByName(large)

    def compaction(self, table: str, last: int) -> str:
        return f"{self.compacted}/{table.rsplit('/', 1)[1]}/upto={last}"

    def compacted_up_to(self, spark: SparkSession) -> int:
        """The last micro-batch of the newest committed compaction, -1 if there is none."""
        if not _readable(spark, self.compactions):
            return -1
        newest = spark.read.schema("rows long, upto int").parquet(self.compactions).agg(F.max("upto")).first()[0]
        return -1 if newest is None else newest

    def read_ledger(self, spark: SparkSession) -> DataFrame:
        if not _readable(spark, self.ledger):
            return spark.createDataFrame([], LEDGER_SCHEMA)
        return spark.read.schema(LEDGER_SCHEMA).parquet(self.ledger)


def ingest_micro_batch(
    messages: DataFrame,
    micro_batch: int,
    store: IngestStore,
    batch_size: int = BATCH_SIZE,
    arity: int = WIRE_FIELD_COUNT,
    positions: dict[str, int] = WIRE_POSITIONS,
) -> int:
    """Parse, quarantine, number and write one micro-batch; returns its accepted rows.

    Parsing is the costly part and several passes use its outcome, so that is
    written to the shared folder, whatever its size, and removed at the end.
    """
    spark = messages.sparkSession
    before, latest = store.rows_before(spark, micro_batch), store.latest_before(spark, micro_batch)
    parsed = parse_messages(messages.select(*ORDER, "value"), arity)
    judged, seen = observed(
        judged_records(parsed, ORDER, positions), [F.max(F.unix_micros("timestamp")).alias("latest")], "arrivals"
    )
    with staging(spark):
        judged = staged(judged, "judged")
        numbered, rows = number_in_order(accepted_records(judged), ORDER, batch_size, before)
        write_batch_store(numbered, store.micro(store.batches, micro_batch))
        rejected_records(judged, ORDER).write.mode("overwrite").parquet(
            store.micro(store.rejects, micro_batch)
        )
    latest = max((t for t in (latest, seen.get["latest"]) if t is not None), default=None)
    store.write_latest(spark, micro_batch, latest)
    store.write_ledger(spark, micro_batch, before, rows)
    return rows


def start_ingest(
    stream: DataFrame,
    base: str,
    checkpoint: str,
    batch_size: int = BATCH_SIZE,
    arity: int = WIRE_FIELD_COUNT,
    positions: dict[str, int] = WIRE_POSITIONS,
    every: str | None = None,
) -> StreamingQuery:
    """Start the ingest: all messages there are, or a micro-batch ``every`` interval.

    Micro-batches follow each other, and rows within one are in order of arrival;
    so the numbers are those of a single batch if messages come in time order.
    """
    store = IngestStore(base)
    store.require_checkpoint(stream.sparkSession, checkpoint)
    store.write_settings(stream.sparkSession, batch_size, positions)

    def write(messages: DataFrame, micro_batch: int) -> None:
        ingest_micro_batch(messages, micro_batch, store, batch_size, arity, positions)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_ingest(stream: DataFrame, base: str, checkpoint: str, **settings) -> IngestStore:
    """Take in everything available and stop."""
    start_ingest(stream, base, checkpoint, **settings).awaitTermination()
    return IngestStore(base)


def export_batch_files(
    spark: SparkSession, store: IngestStore, path: str, final: bool = False
) -> None:
    """Write the full batches that are not at ``path`` yet, one CSV file each.

    Batches that an export has committed and whose file is there stay as they
    are; all others up to the last full one are written, gaps among them, and
    then committed. A file is named after the arrival of its last row, so it has
    the same name whenever it is written, and what an export that broke off has
    left is replaced. With ``final`` the partial last batch is written too, marked
    ``_remaining``; nothing may be taken in after that.
    """
    size, (_, total) = store.settings(spark)["batch_size"], store.committed(spark)
    last = -(-total // size) if final else total // size
    numbers = spark.range(1, last + 1).select(F.col("id").alias("batch_no"))
    with staging(spark):
        missing = staged(numbers.join(exported_batches(spark, path), "batch_no", "left_anti"), "unexported")
        ends = missing.agg(F.min("batch_no").alias("first"), F.max("batch_no").alias("last")).first()
        if ends["first"] is None:
            return
        spans = [batch_span(F.lit(ends[end])) for end in ("first", "last")]
        near = store.read_batches(spark).filter(
            F.col("batch_span").between(*spans) & F.col("batch_no").between(ends["first"], ends["last"])
        )
        named = near.select("batch_no", "timestamp").join(missing, "batch_no", "left_semi").groupBy("batch_no")
        names = staged(named.agg(F.max("timestamp").alias("_written"), F.count(F.lit(1)).alias("rows")), "export-names")
        write_batch_files(
            near.join(names, "batch_no"), path, F.col("_written"), F.col("is_remainder"), only_these=True
        )
        commit_exported(names, path)


def compact_store(spark: SparkSession, store: IngestStore, path: str) -> IngestStore:
    """A copy of the committed rows, rejects and ledger as one micro-batch, with large sorted files.

    Continuing it takes a new checkpoint and messages after those in it, as the
    micro-batches of a stream count from zero.
    """
    compact = IngestStore(path)
    known, (last, rows) = store.settings(spark), store.committed(spark)
    compact.write_settings(spark, known["batch_size"], dict.fromkeys(known["columns"], 0))
    batches = store.read_batches(spark).drop("is_remainder", "batch_span", "micro")
    write_batch_store(batches.repartitionByRange("row_no"), compact.micro(compact.batches, 0))
    rejects = store.read_rejects(spark).drop("micro")
    rejects.write.mode("overwrite").parquet(compact.micro(compact.rejects, 0))
    compact.write_latest(spark, 0, store.latest_before(spark, last + 1))
    compact.write_ledger(spark, 0, 0, rows)
    return compact


def compact_in_place(spark: SparkSession, store: IngestStore, vacuum: bool = False) -> int:
    """Put all committed rows and rejects into large sorted files; returns the last micro-batch among them.

    Checkpoint and ledger stay, so the same stream goes on, and may meanwhile. The
    new files count once their entry is written; a compaction that breaks off
    leaves the store as it was, and the next one replaces its files. ``vacuum`` then
    removes the micro-batches and compactions that the new one stands for; jobs that
    read them must have ended.
    """
    last, total = store.committed(spark)
    if last > store.compacted_up_to(spark):
        rows = store.read_batches(spark).drop("is_remainder", "batch_span")
        target = store.compaction(store.batches, last)
        write_batch_store(rows.repartitionByRange("row_no"), target)
        written = spark.read.parquet(target).count() if total else 0
        if written != total:
            raise RuntimeError(f"{written} rows compacted, {total} in the ledger")
        rejects = store.read_rejects(spark).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
        rejects.write.mode("overwrite").parquet(store.compaction(store.rejects, last))
        entry = spark.range(1).select(F.lit(total).cast("long").alias("rows"))
        entry.write.mode("overwrite").parquet(f"{store.compactions}/upto={last}")
    if vacuum:
        replaced = []
        for table in (store.batches, store.rejects):
            replaced += _numbered_folders(spark, table, "micro", below=last + 1)
            replaced += _numbered_folders(spark, store.compaction(table, last).rsplit("/", 1)[0], "upto", below=last)
        remove_paths(spark, replaced)
    return last


def _numbered_folders(spark: SparkSession, parent: str, key: str, below: int) -> list[str]:
    """Folders ``key=<number>`` in ``parent`` with a smaller number."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parent)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [entry.getPath() for entry in system.listStatus(path)] if system.exists(path) else []
    numbers = {str(p): p.getName().removeprefix(f"{key}=") for p in names if p.getName().startswith(f"{key}=")}
    return [p for p, number in numbers.items() if int(number) < below]
