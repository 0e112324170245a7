"""The columns that the registered queries derive from the operators' results."""

import hashlib

import pytest

from marketloom.llm.queries import QUERIES
from tests.llm.test_pii import KINDS, base

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_pattern_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op2_quality_lines": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept lost_words",
    "op4_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op5_simhash": "doc_id fingerprint component_id kept",
    "op6_lpt_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op9_url_models": "page_id host path rule verdict score",
    "op10_pii_spans": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op11_best_fit_windows": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op12_periodic_runs": "doc_id n_runs start length period runs_sha256 collapsed_sha256 exponent_milli",
    "op13_vector_codes": "vec_id code error label_error codebooks_sha256",
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, name):
    assert QUERIES[name](spark, SMALL).columns == COLUMNS[name].split()


def test_pii_digest(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in QUERIES["op10_pii_spans"](spark, SMALL).collect():
        spans = [f"{KINDS[k]}:{start}:{end}" for start, k, end in base(texts[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(filter(None, r.spans.split(",")))


def test_shards_are_forty(spark):
    rows = QUERIES["op6_lpt_sharding"](spark, SMALL).collect()
    assert {r.shard for r in rows} == set(range(40))
