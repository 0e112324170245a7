"""Records to CSV messages and back, with rejected messages kept apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.csvtext import (
    beyond_limit,
    cell_array,
    csv_line,
    marked_text,
    raw_fields,
    record_of,
    regular_cells,
    utf8_text,
)
from marketloom.schema import PREVIEW_LENGTH, WIRE_FIELD_COUNT, WIRE_POSITIONS


def encode_records(df: DataFrame, columns: Sequence[str], *, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns plus ``value``, the UTF-8 bytes of one CSV line per row."""
    line = csv_line([F.col(f"`{c}`") for c in columns])
    return df.select(*keep, F.encode(line, "UTF-8").alias("value"))


def parse_messages(
    df: DataFrame,
    arity: int = WIRE_FIELD_COUNT,
    value: str = "value",
    field_limit: int | None = None,
) -> DataFrame:
    """Add ``text``, ``fields`` (array of text) and ``reason`` (NULL for a good record).

    Reasons: ``encoding``, ``empty``, ``parse``, ``arity``. Fields may be of any
    length unless ``field_limit`` is given; longer ones then fail the parse.

    Records without quotes and line ends are split at commas, those with regular
    quoting by ``from_csv``, the rest with regular expressions. Each costly step
    sits in a generator over a one-element array: it then runs once, while a plain
    projection would be copied into every later filter and column.
    """

    def once(name: str, column: Column, to: DataFrame) -> DataFrame:
        return to.withColumn(name, F.explode(F.array(column)))

    text, cells = F.col("text"), F.col("_cells")
    steps = once("text", utf8_text(F.col(value)), df)
    steps = once("_csv", regular_cells(text, arity), steps)
    steps = once("_cells", cell_array(F.col("_csv"), arity), steps)
    steps = once("_marked", F.when(cells.isNull(), marked_text(text)), steps)
    steps = once("_tokens", raw_fields(F.col("_marked")), steps)
    record = record_of(text, F.col("_marked"), F.col("_tokens"), field_limit)
    regular = F.struct(cells.alias("fields"), F.lit(None).cast("string").alias("failure"))
    if field_limit is not None:
        too_long = F.when(beyond_limit(text, cells, field_limit), "parse")
        regular = F.struct(cells.alias("fields"), too_long.alias("failure"))
    found = F.when(cells.isNotNull(), regular).otherwise(record)
    parsed = steps.select("*", F.inline(F.array(found)).alias("fields", "failure"))
    return parsed.withColumn(
        "reason",
        F.when(F.col("text").isNull(), "encoding")
        .when(F.col("failure").isNotNull(), F.col("failure"))
        .when(F.size("fields") != arity, "arity"),
    ).drop("_csv", "_cells", "_marked", "_tokens", "failure")


def field(position: int) -> Column:
    """A field of a parsed record; empty text is a missing value."""
    return F.nullif(F.get("fields", F.lit(position)), F.lit(""))


def judged_records(
    parsed: DataFrame,
    keep: Sequence[str] = (),
    positions: Mapping[str, int] = WIRE_POSITIONS,
    value: str = "value",
) -> DataFrame:
    """What is worth keeping of each message: the chosen fields, or all of it and why it was rejected."""
    return parsed.select(
        *keep,
        "reason",
        F.when(F.col("reason") == "arity", F.size("fields")).alias("field_count"),
        F.when(F.col("reason").isNotNull(), F.substring("text", 1, PREVIEW_LENGTH)).alias(
            "preview"
        ),
        F.when(F.col("reason").isNotNull(), F.col(value)).alias("value"),
        *[field(at).alias(name) for name, at in positions.items()],
    )


def accepted_records(judged: DataFrame) -> DataFrame:
    return judged.filter("reason IS NULL").drop("reason", "field_count", "preview", "value")


def rejected_records(judged: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Quarantine rows: reason, field count where known, the start of the text, and the message itself."""
    rejected = judged.filter("reason IS NOT NULL")
    return rejected.select(*keep, "reason", "field_count", "preview", "value")


def project_fields(
    parsed: DataFrame,
    keep: Sequence[str] = (),
    positions: Mapping[str, int] = WIRE_POSITIONS,
) -> DataFrame:
    """Accepted records as named columns picked by source position."""
    return accepted_records(judged_records(parsed, keep, positions))
