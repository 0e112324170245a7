"""Models and itemsets for the three cumulative snapshots."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators.cleaning import (
    clean_features,
    drop_incomplete,
    fill_missing,
    observed,
    profile_columns,
    snapshot_columns,
)
from marketloom.operators.mining import item_support
from marketloom.operators.models import fit_clusters, fit_deviations, fit_projection
from marketloom.operators.snapshots import first_batches, snapshot, tier_of_name, tier_of_rank
from marketloom.schema import (
    CLUSTER_PREFIX,
    CLUSTERS,
    COMPONENTS,
    FEATURES,
    ITEM_COLUMN,
    ITEMSET_PREFIX,
    MIN_SUPPORT,
    MINIMUM_BATCHES,
    PROJECTION_PREFIX,
    SEED,
    SNAPSHOTS,
)
from marketloom.session import staged, staging
from marketloom.sources.artifacts import KINDS, save_itemsets, save_model
from marketloom.sources.batches import list_batch_files, read_batch_files
from marketloom.streaming.ingest import IngestStore

log = logging.getLogger(__name__)


@dataclass
class TrainingReport:
    """Rows read and kept per snapshot, missing values of all rows, and the paths written."""

    rows_read: dict[str, int] = field(default_factory=dict)
    rows_kept: dict[str, int] = field(default_factory=dict)
    profile: dict[str, int] = field(default_factory=dict)
    artifacts: list[str] = field(default_factory=list)


def require_batches(found: int) -> None:
    if found < MINIMUM_BATCHES:
        raise ValueError(
            f"{found} batches found; the cumulative snapshots need {MINIMUM_BATCHES}"
        )


def tiered_batch_files(spark: SparkSession, path: str, order: str = "numeric") -> DataFrame:
    """Text rows of CSV batches with the first snapshot (``tier``) that holds each."""
    first = first_batches(list_batch_files(spark, path), order)
    require_batches(len(first))
    rows = read_batch_files(spark, path)
    return rows.withColumn("tier", tier_of_name(F.col("file_name"), first)).drop("file_name")


def tiered_batch_store(spark: SparkSession, store: IngestStore) -> DataFrame:
    """The same from the committed rows of a batch store, whose batches are numbered in order."""
    rows = store.read_batches(spark)
    last = rows.agg(F.max("batch_no").alias("n")).first()["n"] or 0
    require_batches(last)
    return rows.withColumn("tier", tier_of_rank(F.col("batch_no")))


def stage_features(rows: DataFrame, nan: str = "missing") -> tuple[DataFrame, dict]:
    """Cleaned features, item and tier as a table in the shared folder, and what writing it has found.

    The text is read and cleaned once; every later pass reads seven narrow
    columns, and only the directories of its snapshot. Fill values, row counts and
    the profile of missing values come from the same pass, as it writes.
    """
    cleaned = clean_features(rows).select(*FEATURES, ITEM_COLUMN, "tier")
    noted, found = observed(cleaned, [*snapshot_columns(nan=nan), *profile_columns()], "features")
    return staged(noted, "features", ["tier"]), found.get


def train_snapshots(
    rows: DataFrame,
    models: str,
    nan: str = "missing",
    k: int = CLUSTERS,
    seed: int = SEED,
    components: int = COMPONENTS,
    min_support: float = MIN_SUPPORT,
    kinds: Sequence[str] = tuple(KINDS.values()),
) -> TrainingReport:
    """Fit and save clusters, projection and itemsets for each snapshot of tiered rows."""
    with staging(rows.sparkSession):
        return _train_staged(rows, models, nan, k, seed, components, min_support, kinds)


def _train_staged(
    rows: DataFrame, models: str, nan: str, k: int, seed: int, components: int, min_support: float, kinds: Sequence[str]
) -> TrainingReport:
    report = TrainingReport()
    features, stats = stage_features(rows, nan)
    report.profile = {name: stats[name] for name in stats if name.split("_")[0] not in ("fill", "rows", "kept")}

    def train(tier: int) -> list[str]:
        name = SNAPSHOTS[tier - 1]
        held = snapshot(features, name).drop("tier")
        kept = drop_incomplete(fill_missing(held, stats[f"fill_{tier}"], nan))
        paths = []
        if "kmeans" in kinds or "pca" in kinds:
            vectors = kept.select(*FEATURES)
            deviations = fit_deviations(vectors)
        if "kmeans" in kinds:
            clusters = fit_clusters(vectors, k=k, seed=seed, deviations=deviations)
            paths.append(save_model(clusters, models, CLUSTER_PREFIX + name))
        if "pca" in kinds:
            projection = fit_projection(vectors, k=components, deviations=deviations)
            paths.append(save_model(projection, models, PROJECTION_PREFIX + name))
        if "fpgrowth" in kinds:
            itemsets = item_support(kept, min_support=min_support)
            paths.append(save_itemsets(itemsets, models, ITEMSET_PREFIX + name))
        return paths

    trainable = []
    for tier, name in enumerate(SNAPSHOTS, start=1):
        report.rows_read[name] = stats[f"rows_{tier}"]
        report.rows_kept[name] = stats[f"kept_{tier}"]
        if stats[f"kept_{tier}"]:
            trainable.append(tier)
        else:
            log.warning("no rows to train %s", name)
    # The snapshots are independent and the first two are small: let their jobs overlap.
    with ThreadPoolExecutor(len(SNAPSHOTS)) as pool:
        for paths in pool.map(train, trainable):
            report.artifacts += paths
    return report


def train_from_files(
    spark: SparkSession, batches: str, models: str, order: str = "numeric", **settings
) -> TrainingReport:
    return train_snapshots(tiered_batch_files(spark, batches, order), models, **settings)


def train_from_store(
    spark: SparkSession, store: IngestStore, models: str, **settings
) -> TrainingReport:
    return train_snapshots(tiered_batch_store(spark, store), models, **settings)

