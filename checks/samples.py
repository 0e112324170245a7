"""App-shaped inputs derived from the test tables, as SQL that Spark and DuckDB both run.

Damage follows the data (event types, names, sizes), and every row of a table
takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import csv_line
from marketloom.schema import WIRE_FIELD_COUNT, WIRE_POSITIONS

APP_ROWS = """
SELECT p_partkey AS id,
  p_name AS App,
  CASE WHEN p_name LIKE 'hot %' THEN NULL ELSE p_brand || '/' || p_type END AS Category,
  CASE WHEN p_name LIKE 'old %' THEN NULL WHEN p_name = 'red rod' THEN 'NaN'
       WHEN p_name LIKE '% bolt' THEN 'bad' ELSE CAST(p_size % 6 AS STRING) END AS Rating,
  CAST(p_partkey * 37 AS STRING) AS Reviews,
  CASE p_type WHEN 'ECONOMY' THEN CAST(p_size AS STRING) || 'M'
       WHEN 'MEDIUM' THEN CAST(p_size AS STRING) || 'k'
       WHEN 'PROMO' THEN 'Varies with device'
       WHEN 'LARGE' THEN '1,' || CAST(p_size AS STRING) || 'k'
       WHEN 'SMALL' THEN CAST(p_size AS STRING) || 'MM'
       ELSE CAST(p_size AS STRING) || 'G' END AS Size,
  CASE WHEN p_brand = 'Brand#9' THEN NULL ELSE CAST(p_size AS STRING) || ',000+' END AS Installs,
  CASE WHEN p_name LIKE '% gear' THEN '$' WHEN p_name LIKE '% ring' THEN 'Free' ELSE '' END
    || CAST(p_size AS STRING) AS Price
FROM {part}
"""

# Text of the 24 source fields, by position; the others are short fillers.
_EVENT_FIELDS = {
    0: "'app ' || CAST(event_id AS STRING)",
    1: "props",
    2: "event_type",
    3: "CAST(user_id % 6 AS STRING)",
    4: "CAST(user_id * 37 AS STRING)",
    5: "CAST(user_id AS STRING) || ',000+'",
    6: "''",
    8: "CASE WHEN event_type = 'purchase' THEN 'Paid' ELSE 'Free' END",
    9: "'$' || CAST(user_id AS STRING)",
    10: "' padded '",
    11: "CAST(user_id AS STRING) || 'M'",
    12: "CASE WHEN event_type = 'click' THEN '' ELSE '4.1 and up' END",
    17: "'Jan ' || CAST(user_id AS STRING) || ', 2024'",
    18: "'Everyone \"10+\"'",
    20: "'first line' || chr(10) || 'second line'",
}
EVENT_FIELDS = [_EVENT_FIELDS.get(i, f"'f{i}'") for i in range(WIRE_FIELD_COUNT)]

# How the message of an event is damaged on its way, if at all.
DAMAGE = """CASE
  WHEN event_type = 'error' AND value < 20 THEN 'empty'
  WHEN event_type = 'error' AND value < 50 THEN 'short'
  WHEN event_type = 'error' AND value < 80 THEN 'long'
  WHEN event_type = 'signup' AND value < 5 THEN 'bytes'
  WHEN event_type = 'signup' AND value < 10 THEN 'return'
  ELSE 'good' END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """A test table of one file over several tasks; a large table has enough of them by itself."""
    return df.repartition(8, key)


def app_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(APP_ROWS, part=table(spark, sf_dir, "part"))


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as 24 text fields ``c0`` to ``c23``, with the damage their message takes."""
    fields = [F.expr(sql).alias(f"c{i}") for i, sql in enumerate(EVENT_FIELDS)]
    return dealt(table(spark, sf_dir, "events"), "event_id").select(
        "event_id", "ts", F.expr(DAMAGE).alias("damage"), *fields
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic-shaped messages, some damaged; ``offset`` is the event id."""
    damage, line = F.col("damage"), F.col("line")
    lines = event_records(spark, sf_dir).select(
        "event_id",
        "ts",
        "damage",
        F.explode(F.array(csv_line([F.col(f"c{i}") for i in range(WIRE_FIELD_COUNT)]))).alias("line"),
    )
    # The last field has three characters and the comma before it.
    text = (
        F.when(damage == "empty", "")
        .when(damage == "short", F.substring(line, F.lit(1), F.length(line) - 4))
        .when(damage == "long", F.concat(line, F.lit(",more")))
        .when(damage == "return", F.concat(F.lit("x\ry,"), line))
        .otherwise(line)
    )
    tail = F.when(damage == "bytes", F.lit(bytes([0xFF]))).otherwise(F.lit(b""))
    value = F.concat(F.encode(text, "UTF-8"), tail)
    return lines.select(
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"), "ts", value.alias("value")
    )


def sql_csv_line(fields: list[str]) -> str:
    """The CSV line of SQL text expressions, written out for DuckDB."""
    quoted = [
        f"CASE WHEN regexp_matches({f}, '[\",\\r\\n]') "
        f"THEN '\"' || replace({f}, '\"', '\"\"') || '\"' ELSE {f} END"
        for f in fields
    ]
    return " || ',' || ".join(f"({q})" for q in quoted)


def accepted_sql() -> str:
    """DuckDB: accepted events with the projected fields, empty text as NULL."""
    columns = ", ".join(
        f"nullif({EVENT_FIELDS[at]}, '') AS \"{name}\"" for name, at in WIRE_POSITIONS.items()
    )
    return f"SELECT event_id, ts, {columns} FROM events WHERE {DAMAGE} = 'good'"
