"""What the operators share: reading tables, keeping input columns, word and line patterns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.session import staged

__all__ = ["BLANKS", "ascii_words", "blank_free", "staged", "table", "whole_row", "with_results"]

BLANKS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blank_free(text: Column) -> Column:
    """Text without its ASCII white space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{BLANKS}+", "")


def ascii_words(text: Column) -> Column:
    """Runs of anything but ASCII white space; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{BLANKS}+"), "")


def whole_row(df: DataFrame, names: Iterable[str] | None = None) -> Column:
    """The named columns (all by default) as one struct, so that working columns cannot clash with them."""
    return F.struct(*[df[f"`{name}`"] for name in (df.columns if names is None else names)])


def with_results(df: DataFrame, names: Iterable[str], results: dict[str, Column], row: str = "row") -> DataFrame:
    """Input columns out of the struct ``row``, then the results.

    A result replaces an input column of the same name, whatever its case.
    Results are computed before input names come back, so they cannot meet them.
    """
    taken = {name.lower() for name in results}
    kept = [F.col(f"{row}.`{name}`").alias(name) for name in names if name.lower() not in taken]
    computed = df.select(row, F.struct(*[column.alias(name) for name, column in results.items()]).alias("result"))
    return computed.select(*kept, *[F.col(f"result.`{name}`").alias(name) for name in results])
