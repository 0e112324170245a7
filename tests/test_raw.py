"""Rows of raw CSV files, their places, and the messages made of them."""

import csv
import io
import random

import pytest

from marketloom.plans.ingest import dataset_messages, ingest_topic, publish_dataset
from marketloom.sources import raw
from marketloom.sources.topic import in_publish_order, read_topic


@pytest.fixture
def tiny_splits(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def well_formed(seed, line_end="\n", cells=("a", 'b"c', ",", "\n", '" ', "x\ny", "", "plain", "é")):
    rng = random.Random(seed)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=line_end)
    writer.writerow(["h1", "h2", "h3"])
    for i in range(250):
        writer.writerow([str(i), rng.choice(cells), rng.choice(cells)])
    return out.getvalue()


def python_rows(text):
    return list(csv.reader(io.StringIO(text, newline="")))[1:]


def read(spark, path, **settings):
    rows = raw.read_rows(spark, str(path), arity=3, **settings).orderBy("file_path", "position").collect()
    assert len({(r.file_path, r.position) for r in rows}) == len(rows)
    return [r.fields for r in rows]


def test_rows_may_span_lines(spark, tmp_path):
    text = well_formed(1) + 'short,"x\ny"\nlong,1,2,3\n'
    (tmp_path / "data.csv").write_text(text)
    assert read(spark, tmp_path) == python_rows(text)


def test_lines_of_split_files_keep_their_order(tiny_splits, tmp_path):
    text = well_formed(2, cells=("a", 'b"c', ",", "", "é"))
    for name in ("x", "y"):
        (tmp_path / f"{name}.csv").write_text(text)
    assert tiny_splits.read.csv(str(tmp_path)).rdd.getNumPartitions() > 20
    assert read(tiny_splits, tmp_path, multiline=False) == 2 * python_rows(text)


def test_long_fields_are_read(spark, tmp_path):
    (tmp_path / "data.csv").write_text('h,h,h\na,"' + "é\n" * 100_000 + '",b\n')
    assert read(spark, tmp_path) == [["a", "é\n" * 100_000, "b"]]


@pytest.mark.parametrize("multiline", [True, False])
def test_places_over_several_files_are_unique(spark, tmp_path, multiline):
    record = ",".join(f"f{i}" for i in range(23))
    for k in range(3):
        rows = ["h" * 3, *[f"{record},{k}-{i}" for i in range(200)]]
        (tmp_path / f"part {k}.csv").write_text("\n".join(rows))
    messages = dataset_messages(spark, str(tmp_path), "t", multiline).collect()
    assert len({(m.partition, m.offset) for m in messages}) == len(messages) == 600
    said = [bytes(m.value).decode().rsplit(",", 1)[1] for m in sorted(messages, key=lambda m: (m.partition, m.offset))]
    assert said == [f"{k}-{i}" for k in range(3) for i in range(200)]


def test_datasets_of_several_files_are_numbered_in_order(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text("h,h\n" + "".join(f"{k},{i}\n" for i in range(100)))
    messages = dataset_messages(spark, str(tmp_path), "t", arity=2)
    store = ingest_topic(messages, str(tmp_path / "store"), 70, arity=2, positions={"k": 0, "i": 1})
    rows = store.read_batches(spark).orderBy("row_no").collect()
    assert [(r.k, r.i) for r in rows] == [(str(k), str(i)) for k in range(3) for i in range(100)]
    assert [r.batch_no for r in rows] == [n // 70 + 1 for n in range(300)]


def test_publish_writes_encoded_records_in_order(spark, tmp_path):
    (tmp_path / "data.csv").write_text('h1,h2\n"a",1\n"b, ""c""",2\n" d",3 \n')
    publish_dataset(spark, str(tmp_path / "data.csv"), "apps", str(tmp_path / "topic"))
    rows = read_topic(spark, str(tmp_path / "topic")).orderBy("offset").collect()
    assert [bytes(r.value).decode() for r in rows] == ["a,1", '"b, ""c""",2', "d,3"]
    assert {(r.topic, r.partition, r.key) for r in rows} == {("apps", 0, None)}


@pytest.mark.parametrize("partitions", [1, 2])
def test_brokers_get_each_partition_in_order(spark, tmp_path, partitions):
    for k in range(4):
        (tmp_path / f"{k}.csv").write_text("h\n" + "".join(f"{k}-{i}\n" for i in range(50)))
    messages = dataset_messages(spark, str(tmp_path), "t", arity=1).repartition(7)
    sent = {}
    for row in in_publish_order(messages, partitions).collect():
        sent.setdefault(row.partition, []).append(bytes(row.value).decode())
    assert sent == {
        p: [f"{k}-{i}" for k in range(p, 4, partitions) for i in range(50)] for p in range(partitions)
    }
