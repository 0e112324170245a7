import os
import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from marketloom.operators import snapshots
from marketloom.operators.batching import number_batches
from marketloom.operators.wire import parse_messages, project_fields
from marketloom.plans.ingest import ingest_topic
from marketloom.schema import BATCH_COLUMNS
from marketloom.sources import batches, topic
from marketloom.streaming import ingest

POSITIONS = {"left": 0, "right": 1}
SETTINGS = {"batch_size": 100, "arity": 2, "positions": POSITIONS}


def messages(spark, count=2_000):
    """Every 7th message is too short, every 11th is empty."""
    line = (
        F.when(F.col("id") % 11 == 0, "").when(F.col("id") % 7 == 0, "short")
        .otherwise(F.concat(F.lit("v"), F.col("id").cast("string"), F.lit(',"x, y"')))
    )
    rows = spark.range(count).select(
        "id",
        (F.col("id") % 3).alias("place"),
        F.timestamp_seconds(F.col("id")).alias("at"),
        F.encode(line, "UTF-8").alias("value"),
    )
    return topic.as_messages(rows, "t", "id", "place", "at")


def deliver(df, path, files=6):
    """Files whose modification times follow the offsets."""
    topic.write_topic(df.repartitionByRange(files, "offset"), path)
    parts = sorted(n for n in os.listdir(path) if n.endswith(".parquet"))
    for i, name in enumerate(parts):
        os.utime(f"{path}/{name}", (1_700_000_000 + i, 1_700_000_000 + i))


def in_batch(spark, count=2_000):
    """All at once; messages come in the order of their ids over three topic partitions."""
    accepted = project_fields(parse_messages(messages(spark, count), 2), ["offset"], POSITIONS)
    return rows_of(number_batches(accepted, 100, partition=None))


def rows_of(df):
    return sorted((r.offset, r.left, r.right, r.row_no, r.batch_no) for r in df.collect())


@pytest.mark.parametrize("per_trigger", [None, 1, 2])
def test_stream_equals_batch(spark, tmp_path, per_trigger):
    base = str(tmp_path)
    deliver(messages(spark), f"{base}/topic")
    stream = topic.stream_topic(spark, f"{base}/topic", per_trigger=per_trigger)
    store = ingest.run_ingest(stream, f"{base}/out", f"{base}/cp", **SETTINGS)
    got = store.read_batches(spark)
    want = in_batch(spark)
    assert rows_of(got) == want
    last = max(r[4] for r in want)
    assert {r.batch_no for r in got.filter("is_remainder").collect()} == {last}
    rejects = store.read_rejects(spark)
    assert rejects.count() + len(want) == 2_000
    ledger = store.read_ledger(spark).orderBy("micro").collect()
    assert len(ledger) == {None: 1, 1: 6, 2: 3}[per_trigger]
    assert ledger[-1].rows_after == len(want)


def test_restart_adds_nothing_twice(spark, tmp_path):
    base = str(tmp_path)
    deliver(messages(spark), f"{base}/topic")
    for _ in range(2):
        stream = topic.stream_topic(spark, f"{base}/topic", per_trigger=3)
        store = ingest.run_ingest(stream, f"{base}/out", f"{base}/cp", **SETTINGS)
    assert rows_of(store.read_batches(spark)) == in_batch(spark)


def test_crash_between_output_and_ledger(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    deliver(messages(spark), f"{base}/topic")
    write = ingest.IngestStore.write_ledger

    def failing(self, session, micro_batch, before, rows):
        if micro_batch == 2:
            raise OSError("killed")
        write(self, session, micro_batch, before, rows)

    monkeypatch.setattr(ingest.IngestStore, "write_ledger", failing)
    stream = topic.stream_topic(spark, f"{base}/topic", per_trigger=1)
    with pytest.raises(StreamingQueryException, match="killed"):
        ingest.run_ingest(stream, f"{base}/out", f"{base}/cp", **SETTINGS)
    monkeypatch.setattr(ingest.IngestStore, "write_ledger", write)
    store = ingest.IngestStore(f"{base}/out")
    last, committed = store.committed(spark)
    between = store.read_batches(spark)
    assert last == 1 and os.path.isdir(store.micro(store.batches, 2))
    assert rows_of(between) == in_batch(spark)[:committed]
    assert {r.batch_no for r in between.filter("is_remainder").collect()} == {committed // 100 + 1}
    assert store.read_rejects(spark).agg(F.max("micro")).first()[0] == 1
    stream = topic.stream_topic(spark, f"{base}/topic", per_trigger=1)
    store = ingest.run_ingest(stream, f"{base}/out", f"{base}/cp", **SETTINGS)
    assert rows_of(store.read_batches(spark)) == in_batch(spark)


def test_new_checkpoint_on_old_rows_is_refused(spark, tmp_path):
    base = str(tmp_path)
    topic.write_topic(messages(spark, 200), f"{base}/topic")
    stream = topic.stream_topic(spark, f"{base}/topic")
    ingest.run_ingest(stream, f"{base}/out", f"{base}/cp", **SETTINGS)
    with pytest.raises(ValueError, match="no progress"):
        ingest.run_ingest(stream, f"{base}/out", f"{base}/other", **SETTINGS)


def test_lost_ledger_is_reported(spark, tmp_path):
    store = ingest.IngestStore(str(tmp_path))
    with pytest.raises(RuntimeError, match="ledger entry 3"):
        store.rows_before(spark, 4)


def test_batch_size_is_fixed(spark, tmp_path):
    store = ingest.IngestStore(str(tmp_path))
    store.write_settings(spark, 100)
    store.write_settings(spark, 100)
    with pytest.raises(ValueError, match="batches of 100"):
        store.write_settings(spark, 99)


def test_whole_topic_at_once(spark, tmp_path):
    base = str(tmp_path)
    topic.write_topic(messages(spark), f"{base}/topic")
    store = ingest_topic(topic.read_topic(spark, f"{base}/topic"), f"{base}/out", **SETTINGS)
    assert rows_of(store.read_batches(spark)) == in_batch(spark)


def test_only_rejects(spark, tmp_path):
    base = str(tmp_path)
    topic.write_topic(messages(spark).filter("offset % 7 = 0"), f"{base}/topic")
    stream = topic.stream_topic(spark, f"{base}/topic")
    store = ingest.run_ingest(stream, f"{base}/out", f"{base}/cp", **SETTINGS)
    assert store.read_rejects(spark).count() == 286
    assert store.read_ledger(spark).first().rows_after == 0
    assert store.read_batches(spark).count() == 0
    assert {bytes(r.value) for r in store.read_rejects(spark).collect()} == {b"", b"short"}


def test_nothing_taken_in_yet(spark, tmp_path):
    store = ingest.IngestStore(str(tmp_path))
    assert store.committed(spark) == (-1, 0)


def test_nothing_staged_is_left_behind(spark, tmp_path):
    base, shared = str(tmp_path), spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    topic.write_topic(messages(spark), f"{base}/topic")
    ingest_topic(topic.read_topic(spark, f"{base}/topic"), f"{base}/out", **SETTINGS)
    assert {n for n in os.listdir(shared) if not n.startswith(".")} <= before


def test_export_adds_only_new_batches(spark, tmp_path):
    base = str(tmp_path)
    columns = dict.fromkeys(BATCH_COLUMNS, 0)
    settings = {"batch_size": 100, "arity": 2, "positions": columns}
    halves = [messages(spark).filter("offset < 1000"), messages(spark).filter("offset >= 1000")]
    store, seen = ingest.IngestStore(f"{base}/out"), []
    store.write_settings(spark, 100, columns)
    for place, half in enumerate(halves):
        ingest.ingest_micro_batch(half, place, store, **settings)
        ingest.export_batch_files(spark, store, f"{base}/csv", final=place == 1)
        seen.append({str(p.relative_to(base)): p.stat().st_mtime_ns for p in tmp_path.glob("csv/**/*.csv") if p.is_file()})
    assert len(seen[0]) == store_rows(spark, store, 0) // 100
    assert seen[0].items() <= seen[1].items()  # neither renamed nor written again
    names = snapshots.parse_batch_names(batches.list_batch_files(spark, f"{base}/csv")).collect()
    total = store.committed(spark)[1]
    assert sorted(r.batch_no for r in names) == list(range(1, -(-total // 100) + 1))
    assert {r.batch_no for r in names if r.is_remainder} == {total // 100 + 1}
    assert batches.read_batch_files(spark, f"{base}/csv").count() == total


def exported_store(spark, base):
    columns = dict.fromkeys(BATCH_COLUMNS, 0)
    store = ingest.IngestStore(f"{base}/out")
    store.write_settings(spark, 100, columns)
    ingest.ingest_micro_batch(messages(spark), 0, store, batch_size=100, arity=2, positions=columns)
    ingest.export_batch_files(spark, store, f"{base}/csv", final=True)
    return store


def exported_files(tmp_path):
    return {p.parent.name: p for p in tmp_path.glob("csv/**/part-*.csv")}


def exported_rows(spark, base):
    return sorted(map(tuple, batches.read_batch_files(spark, f"{base}/csv").collect()), key=repr)


def test_export_fills_gaps(spark, tmp_path):
    """A batch in the middle is lost, another one was never committed; the others stay untouched."""
    store = exported_store(spark, str(tmp_path))
    whole, files = exported_rows(spark, tmp_path), exported_files(tmp_path)
    names = sorted(files, key=lambda n: int(n.split("_")[2]))
    shutil.rmtree(files[names[4]].parent)
    committed = spark.read.parquet(f"{tmp_path}/csv/_exported").filter("batch_no <> 8").collect()
    shutil.rmtree(tmp_path / "csv/_exported")
    batches.commit_exported(spark.createDataFrame(committed), f"{tmp_path}/csv")
    files[names[7]].write_text("cut off")
    before = {n: p.stat().st_mtime_ns for n, p in exported_files(tmp_path).items()}
    ingest.export_batch_files(spark, store, f"{tmp_path}/csv", final=True)
    after = exported_files(tmp_path)
    assert sorted(after) == sorted(files)
    assert {n for n, at in before.items() if after[n].stat().st_mtime_ns != at} == {names[7]}
    assert exported_rows(spark, tmp_path) == whole
    assert {r.batch_no for r in batches.exported_batches(spark, f"{tmp_path}/csv").collect()} == set(range(1, len(names) + 1))


def test_a_whole_export_writes_nothing(spark, tmp_path):
    store = exported_store(spark, str(tmp_path))
    before = {n: p.stat().st_mtime_ns for n, p in exported_files(tmp_path).items()}
    ingest.export_batch_files(spark, store, f"{tmp_path}/csv", final=True)
    assert {n: p.stat().st_mtime_ns for n, p in exported_files(tmp_path).items()} == before


def store_rows(spark, store, micro):
    return store.read_ledger(spark).filter(F.col("micro") == micro).first().rows_after


def test_compaction_keeps_the_committed_rows(spark, tmp_path):
    base = str(tmp_path)
    deliver(messages(spark), f"{base}/topic")
    stream = topic.stream_topic(spark, f"{base}/topic", per_trigger=1)
    store = ingest.run_ingest(stream, f"{base}/out", f"{base}/cp", **SETTINGS)
    compact = ingest.compact_store(spark, store, f"{base}/compact")
    assert rows_of(compact.read_batches(spark)) == rows_of(store.read_batches(spark))
    assert compact.read_rejects(spark).count() == store.read_rejects(spark).count()
    assert compact.committed(spark) == (0, store.committed(spark)[1])


@pytest.mark.parametrize("vacuum", [False, True])
def test_a_stream_goes_on_over_a_compaction(spark, tmp_path, vacuum):
    base = str(tmp_path)
    halves = [messages(spark).filter("offset < 900"), messages(spark).filter("offset >= 900")]
    for place, half in enumerate(halves):
        deliver(half, f"{base}/topic")
        stream = topic.stream_topic(spark, f"{base}/topic", per_trigger=1)
        store = ingest.run_ingest(stream, f"{base}/out", f"{base}/cp", **SETTINGS)
        if not place:
            before = rows_of(store.read_batches(spark)), store.read_rejects(spark).count()
            last = ingest.compact_in_place(spark, store, vacuum)
            assert last == store.compacted_up_to(spark) == store.committed(spark)[0]
            assert (rows_of(store.read_batches(spark)), store.read_rejects(spark).count()) == before
            assert any(tmp_path.glob("out/batches/micro=*")) != vacuum
    assert rows_of(store.read_batches(spark)) == in_batch(spark)
    ingest.compact_in_place(spark, store, vacuum)
    assert rows_of(store.read_batches(spark)) == in_batch(spark)
    assert len(list(tmp_path.glob("out/compacted/batches/upto=*"))) == 2 - vacuum


def test_a_compaction_that_breaks_off_is_not_read(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    topic.write_topic(messages(spark), f"{base}/topic")
    store = ingest_topic(topic.read_topic(spark, f"{base}/topic"), f"{base}/out", **SETTINGS)
    monkeypatch.setattr(ingest.IngestStore, "read_rejects", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest.compact_in_place(spark, store)
    monkeypatch.undo()
    assert store.compacted_up_to(spark) == -1 and rows_of(store.read_batches(spark)) == in_batch(spark)
    assert ingest.compact_in_place(spark, store, vacuum=True) == 0
    assert rows_of(store.read_batches(spark)) == in_batch(spark)
    assert ingest.compact_in_place(spark, store) == 0  # nothing new


def test_nothing_to_compact(spark, tmp_path):
    assert ingest.compact_in_place(spark, ingest.IngestStore(str(tmp_path)), vacuum=True) == -1


def test_kafka_options():
    class Reader:
        def __init__(self):
            self.said = {}

        def format(self, name):
            return self.option("format", name)

        def option(self, key, value):
            self.said[key] = value
            return self

        def options(self, **more):
            self.said |= more
            return self

        def load(self):
            return self.said

    class Session:
        read = readStream = property(lambda self: Reader())  # noqa: N815

    said = topic.stream_topic(Session(), kafka={"subscribe": "t"}, per_trigger=5, min_partitions=3)
    assert said == {
        "format": "kafka", "startingOffsets": "earliest", "subscribe": "t", "maxOffsetsPerTrigger": 5, "minPartitions": 3,
    }
    assert "maxOffsetsPerTrigger" not in topic.read_topic(Session(), kafka={"subscribe": "t"})
