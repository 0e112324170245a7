"""Messy numeric text to double; malformed text becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_number(text: Column) -> Column:
    return text.try_cast("double")


def installs_number(text: Column) -> Column:
    """``1,000+`` to 1000.0."""
    return F.translate(text, "+,", "").try_cast("double")


def price_number(text: Column) -> Column:
    """``$1.99`` to 1.99."""
    return F.replace(text, F.lit("$"), F.lit("")).try_cast("double")


def size_megabytes(text: Column) -> Column:
    """``10M`` to 10.0 and ``512k`` to 0.5; any other text is NULL."""
    megabytes = F.replace(text, F.lit("M"), F.lit("")).try_cast("double")
    kilobytes = F.replace(text, F.lit("k"), F.lit("")).try_cast("double")
    return F.when(text.endswith("M"), megabytes).when(text.endswith("k"), kilobytes / 1024)
