"""Typed features from text columns, and the handling of missing values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from marketloom.functions import installs_number, plain_number, price_number, size_megabytes
from marketloom.schema import FEATURES, ITEM_COLUMN, SNAPSHOTS, UNKNOWN_ITEM

MEAN_FILLED = "Rating"


def clean_features(df: DataFrame) -> DataFrame:
    """The five text features as doubles, in one projection."""
    return df.withColumns(
        {
            "Rating": plain_number(F.col("Rating")),
            "Reviews": plain_number(F.col("Reviews")),
            "Size": size_megabytes(F.col("Size")),
            "Installs": installs_number(F.col("Installs")),
            "Price": price_number(F.col("Price")),
        }
    )


def present(column: str, nan: str) -> Column:
    """The value, with NaN as NULL under the ``missing`` policy."""
    if nan not in ("missing", "propagate"):
        raise ValueError(f"unknown NaN policy: {nan}")
    return F.nanvl(column, F.lit(None).cast("double")) if nan == "missing" else F.col(column)


def mean_fill_value(df: DataFrame, column: str = MEAN_FILLED, nan: str = "missing") -> DataFrame:
    """One row with the fill value: the mean, or 0.0 if there is no value."""
    return df.agg(F.coalesce(F.avg(present(column, nan)), F.lit(0.0)).alias("fill"))


def snapshot_statistics(
    df: DataFrame, tier: str = "tier", column: str = MEAN_FILLED, nan: str = "missing"
) -> DataFrame:
    """One row with the columns of ``snapshot_columns``, from one pass."""
    return df.agg(*snapshot_columns(tier, column, nan))


def snapshot_columns(tier: str = "tier", column: str = MEAN_FILLED, nan: str = "missing") -> list[Column]:
    """Aggregates ``fill_s``, ``rows_s`` and ``kept_s`` per cumulative snapshot.

    The fill value is the mean of a snapshot, ``rows_s`` counts its rows, and
    ``kept_s`` those that are complete after filling: all of them, or only the
    rated ones if a NaN made the mean useless.
    """
    columns = []
    for s in range(1, len(SNAPSHOTS) + 1):
        held = F.col(tier) <= s
        rated = held & F.col(column).isNotNull() & ~F.isnan(column)
        fill = F.coalesce(F.avg(F.when(held, present(column, nan))), F.lit(0.0))
        rows = F.count_if(held)
        columns += [
            fill.alias(f"fill_{s}"),
            rows.alias(f"rows_{s}"),
            F.when(F.isnan(fill), F.count_if(rated)).otherwise(rows).alias(f"kept_{s}"),
        ]
    return columns


def snapshot_fill(fills: DataFrame, snapshot: Column) -> Column:
    """The fill value of a row's snapshot, out of the one row with all of them."""
    value = F.lit(None).cast("double")
    for tier, name in enumerate(SNAPSHOTS, start=1):
        value = F.when(snapshot == name, fills.select(f"fill_{tier}").scalar()).otherwise(value)
    return value


def fill_missing(
    df: DataFrame, mean: Column | float | None = None, nan: str = "missing"
) -> DataFrame:
    """Rating gets the mean, other features 0.0 and the item column ``Unknown``.

    Without ``mean`` it comes from a scalar subquery over ``df``. Under
    ``propagate`` a single NaN makes the mean NaN and with it the filled values,
    so ``drop_incomplete`` removes those rows; under ``missing`` they get the
    mean of the real values.
    """
    if mean is None:
        mean = mean_fill_value(df, nan=nan).scalar()
    elif not isinstance(mean, Column):
        mean = F.lit(float(mean))
    missing = F.lit(None).cast("double")
    filled: dict[str, Column] = {
        c: F.coalesce(F.nanvl(F.col(c), missing), mean if c == MEAN_FILLED else F.lit(0.0))
        for c in FEATURES
    }
    filled[ITEM_COLUMN] = F.coalesce(F.col(ITEM_COLUMN), F.lit(UNKNOWN_ITEM))
    return df.withColumns(filled)


def drop_incomplete(
    df: DataFrame, columns: Sequence[str] = (*FEATURES, ITEM_COLUMN)
) -> DataFrame:
    """Rows without NULL or NaN in ``columns``."""
    return df.na.drop(subset=list(columns))


def prepare(df: DataFrame, nan: str = "missing") -> DataFrame:
    """Text rows to complete rows: clean, fill, drop."""
    return drop_incomplete(fill_missing(clean_features(df), nan=nan))


def missing_count(column: str, numeric: bool) -> Column:
    test = F.col(f"`{column}`").isNull()
    if numeric:
        test = test | F.isnan(column)
    return F.count_if(test)


def profile(
    df: DataFrame, numeric: Sequence[str] = FEATURES, text: Sequence[str] = (ITEM_COLUMN,)
) -> DataFrame:
    """One row with the columns of ``profile_columns``, by a pass of its own."""
    return df.agg(*profile_columns(numeric, text))


def observed(df: DataFrame, columns: Sequence[Column], name: str) -> tuple[DataFrame, Observation]:
    """``df`` and what its next write will have found of ``columns``, aggregates that this write computes on its way."""
    found = Observation(name)
    return df.observe(found, *columns), found


def profile_columns(numeric: Sequence[str] = FEATURES, text: Sequence[str] = (ITEM_COLUMN,)) -> list[Column]:
    """Aggregates: all rows, complete rows, and missing values per column."""
    incomplete = F.lit(False)
    for c in numeric:
        incomplete = incomplete | F.col(c).isNull() | F.isnan(c)
    for c in text:
        incomplete = incomplete | F.col(c).isNull()
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(~incomplete).alias("complete_rows"),
        *[missing_count(c, True).alias(f"missing_{c.lower()}") for c in numeric],
        *[missing_count(c, False).alias(f"missing_{c.lower()}") for c in text],
    ]


def schema_listing(df: DataFrame) -> Mapping[str, str]:
    """Column names and types, as far as known without running a job."""
    return dict(df.dtypes)
