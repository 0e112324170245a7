"""The registered queries: each operator with its production parameters over its whole table."""

from __future__ import annotations

from hashlib import sha256

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import ascii_words, staged, table
from marketloom.llm.exact import exact_duplicates
from marketloom.llm.licenses import license_paragraphs, sample_paragraphs, train
from marketloom.llm.mixing import mix_to_weights
from marketloom.llm.packing import pack
from marketloom.llm.periodic import periodic_runs
from marketloom.llm.pii import KINDS, personal_spans, spans_text
from marketloom.llm.quality import judge_lines
from marketloom.llm.sharding import balanced_shards
from marketloom.llm.simhash import simhash_groups
from marketloom.llm.token_counts import edited_counts, masked, token_trees
from marketloom.llm.urls import Rule, filter_urls
from marketloom.llm.vector_codes import compress_vectors
from marketloom.llm.windows import pack_windows


TOKENIZER = "byte_bpe_50k.json"


def op1_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), capacity=1024, end_id=2)


QUALITY_COLUMNS = (
    "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept lost_words"
).split()


def op2_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_lines(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(*QUALITY_COLUMNS)


def op3_license_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = license_paragraphs(docs, train(sample_paragraphs(docs)), carry=["doc_id"])
    named = F.transform("licenses", lambda x: F.concat_ws(":", x["paragraph"].cast("string"), x["family"]))
    return found.select("doc_id", "n_paragraphs", F.size("licenses").alias("n_licenses"), F.array_join(named, ",").alias("licenses"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), carry=["doc_id"], write_hashes=True)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), words=4, max_bits=4, carry=["doc_id"])


SHARD_COLUMNS = "doc_id size text_crc32 law shard slot grown_shard".split()


def op6_lpt_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(table(spark, sf_dir, "documents"), shards=40, carry=["doc_id"]).select(*SHARD_COLUMNS)


#: Numbers, runs of symbols and shouting; each becomes one mark.
MASKED, MASK = r"[0-9]{2,}|[#$%&*]{2,}|!{2,}", "#"


def op7_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    docs = masked(table(spark, sf_dir, "documents").select("doc_id", "text"), MASKED, MASK)
    counted = edited_counts(token_trees(docs, path, carry=["doc_id", "edits"]), path)
    return counted.select("doc_id", "n_tokens", F.size("edits").alias("n_edits"), "n_tokens_after", "n_encoded")


DOMAIN_WEIGHTS = {"good": 0.97, "toxic": 0.02, "poor": 0.01}


def op8_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").otherwise("good")
    labels = table(spark, sf_dir, "labels").select("doc_id", domain.alias("domain"))
    return mix_to_weights(table(spark, sf_dir, "documents"), labels, DOMAIN_WEIGHTS, carry=["doc_id"])


URL_RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]


def op9_url_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = filter_urls(table(spark, sf_dir, "pages"), URL_RULES, carry=["page_id"])
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op10_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_spans(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select(
        "doc_id",
        *[f"n_{kind}" for kind in KINDS],
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def op11_best_fit_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_windows(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), capacity=1024, end_id=0)


def with_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, where some documents repeat a part of theirs up to the end, as their numbers say.

    h is the checksum of the number, g a tenth of it. Where h ends in 0, words from
    a = g % n on become the p words from a on, again and again; NULL numbers have none.
    """
    h, n, a, p = (F.col(name) for name in "hnap")
    g = F.floor(h / 10)
    numbered = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    chosen = numbered.withColumn("words", F.when(h % 10 == 0, ascii_words(F.col("text"))))
    counted = chosen.withColumn("n", F.greatest(F.size("words"), F.lit(1)).cast("long"))
    placed = counted.withColumn("a", g % n).withColumn("p", 1 + F.floor((n - a) / (3 + g % 8)))
    a, p, n = a.cast("int"), p.cast("int"), n.cast("int")
    block = F.slice("words", a + 1, p)
    again = F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int")))
    repeated = F.slice(F.concat(F.slice("words", F.lit(1), a), again), F.lit(1), n)
    text = F.when(F.size("words") > 0, F.array_join(repeated, " ")).otherwise(F.col("text"))
    return placed.select("doc_id", text.alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repeats(table(spark, sf_dir, "documents")), carry=["doc_id"])
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[name].cast("string") for name in ("start", "length", "period")]), F.lit("\n")))
    named = found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.back")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.short")).alias("period"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return named.withColumn("exponent_milli", F.expr("1000 * length div period"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    compressed = compress_vectors(table(spark, sf_dir, "embeddings"), carry=["vec_id", "label"])
    coded = staged(compressed.codes, "vector-codes")
    # Written first, so that a label of very many rows meets its sum in a join that can be split.
    errors = staged(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    digits = F.transform("code", lambda x: F.lpad(F.lower(F.hex(x)), 2, "0"))
    numbers = ",".join(map(str, compressed.codebooks.ravel().tolist()))
    return coded.join(errors.withColumnRenamed("label", "of"), F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id",
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"),
    )


QUERIES = {f.__name__: f for f in (op1_pattern_packing, op2_quality_lines, op3_license_paragraphs, op4_exact_dedup, op5_simhash, op6_lpt_sharding, op7_edit_token_counts, op8_soft_mixing, op9_url_models, op10_pii_spans, op11_best_fit_windows, op12_periodic_runs, op13_vector_codes)}
