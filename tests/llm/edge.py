"""Rows that every operator must bear: nulls, blanks, repeats, very long texts, clashing names."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LONG = "many words make a long text. " * 12_000
UNBROKEN = "7" * 40_000 + "x" * 40_000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, "a plain text of a few words.", "en", "s", 28),
    (1, "a plain text of a few words.", "en", "s", 28),
    (2, "a plain text of  a few words.", None, "s", None),
    (3, "", "en", None, 0),
    (4, " \n\t ", "en", "s", 4),
    (5, None, None, None, None),
    (None, None, None, None, None),
    (None, "no key here", "en", "s", 11),
    (6, LONG, "en", "s", len(LONG)),
    (7, UNBROKEN, "en", "s", len(UNBROKEN)),
    (8, "Ünïcode ✓ 漢字 🙂 text", "xx", "s", 20),
]


def documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROWS, SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def clashing(spark: SparkSession, *names: str) -> DataFrame:
    """The same rows with further columns of names that operators use or return."""
    used = ("row", "id", "uid", "hash", "words", "pin", "found", "task", "KEPT", *names)
    return documents(spark).select("*", *[F.lit("mine").alias(name) for name in dict.fromkeys(used)])
