"""Documents to packed training sequences, stage by stage.

Every stage takes the documents its predecessor kept and returns documents; the
last returns the pieces of the packed sequences. Columns of documents that the
operators do not know, whatever their names, go through unchanged.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import staged, table, whole_row
from marketloom.llm.exact import exact_duplicates
from marketloom.llm.mixing import mix_to_weights, repeat_by_rate
from marketloom.llm.packing import pack
from marketloom.llm.quality import judge_lines
from marketloom.llm.simhash import simhash_groups
from marketloom.session import hand_over, remove_paths, shared_dir, staging

TOKENIZER = "byte_bpe_50k.json"
WEIGHTS = {"clean": 0.98, "toxic": 0.02}
#: Documents of at least this rate stay for sure, so that chance takes no clean ones.
SURE = 0.75


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that break a rule; those that fail go, NULL and empty texts among them.

    ``n_chars`` is counted anew. A line that mentions a boilerplate phrase among
    many other words stays. See ``judge_lines`` for the rules.
    """
    kept = judge_lines(_wrapped(docs)).where("kept")
    changed = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    return kept.select(*[changed.get(name, F.col(f"row.`{name}`")).alias(name) for name in docs.columns])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts; see ``exact_duplicates`` for nulls and ties."""
    return _unwrapped(exact_duplicates(_wrapped(docs), carry=["row"]).where("kept"), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies; see ``simhash_groups`` for nulls and ties.

    Texts are told apart by a number of their own; only the numbers of documents
    that go are joined with the texts.
    """
    numbered = staged(docs.select(whole_row(docs).alias("row"), F.monotonically_increasing_id().alias("uid")), "near-rows")
    judged = simhash_groups(numbered.select("uid", "row.doc_id", "row.text"), words=4, max_bits=4, carry=["uid"])
    dropped = staged(judged.where("not kept").select("uid"), "near-dropped")
    return _unwrapped(numbered.join(dropped, "uid", "left_anti"), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the rate says that brings toxic text down to its weight.

    Domains are learned from ``labels``. The weight of toxic text is a ceiling: rates
    above one count as one, so no document is there twice. Rates of ``SURE`` and more
    count as one too, so clean documents, whose rates are near one, stay; of the others
    each stays by a chance as large as its rate. See ``mix_to_weights`` for nulls, ties
    and missing labels.
    """
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("toxic") == 0, "clean")
    labels = table(spark, sf_dir, "labels").select("doc_id", domain.alias("domain"))
    rated = mix_to_weights(_wrapped(docs), labels, WEIGHTS)
    rated = rated.withColumn("rate", F.when(F.col("rate") >= SURE, 1.0).otherwise(F.col("rate")))
    return _unwrapped(repeat_by_rate(rated, ["row"]), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 1024 tokens; see ``pack``."""
    return pack(docs, public_tokenizers.path(TOKENIZER), capacity=1024, end_id=2)


def _wrapped(docs: DataFrame) -> DataFrame:
    """The whole row beside key and text, so that other columns meet no name of an operator's."""
    return docs.select(whole_row(docs).alias("row"), "doc_id", "text")


def _unwrapped(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"row.`{name}`").alias(name) for name in docs.columns])


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", near_dedup),
    ("mixing to target weights", mix_sources),
    ("pattern packing", pack_sequences),
]
#: Token ids, hashes of shingles and fitted rates are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again.

    What a stage's operators have staged goes once the stage is written, and the
    stage before with it. The result still reads the last ones; ``release`` removes them.
    """
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        path = shared_dir(spark, "pipeline-" + name.replace(" ", "-"))
        with staging(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        remove_paths(spark, before)
        docs, before = spark.read.schema(out.schema).parquet(path), [path]
    hand_over(before)
    return STAGES[-1][1](spark, docs, sf_dir)
