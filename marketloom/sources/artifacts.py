"""Saved models and itemsets: one directory each, the kind told by the name."""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.schema import CLUSTER_PREFIX, ITEMSET_PREFIX, PROJECTION_PREFIX

log = logging.getLogger(__name__)

KINDS = {CLUSTER_PREFIX: "kmeans", PROJECTION_PREFIX: "pca", ITEMSET_PREFIX: "fpgrowth"}


#: The list of what was saved, a folder of one row a save; readers of artifacts pass over its name.
MANIFEST = "_manifest"
_MANIFEST_SCHEMA = "name string, saved timestamp, version string"


def save_model(model: PipelineModel, base: str, name: str) -> str:
    path = f"{base}/{name}"
    model.write().overwrite().save(path)
    record_artifact(SparkSession.active(), base, name)
    return path


def save_itemsets(itemsets: DataFrame, base: str, name: str) -> str:
    path = f"{base}/{name}"
    itemsets.write.mode("overwrite").parquet(path)
    record_artifact(itemsets.sparkSession, base, name)
    return path


def record_artifact(spark: SparkSession, base: str, name: str) -> None:
    """Say that ``name`` is whole, as of a new version, once its files are there.

    Every save writes a folder of its own, so savers at the same time do not meet.
    """
    row = spark.range(1).select(F.lit(name).alias("name"), F.current_timestamp().alias("saved"))
    row.write.parquet(f"{base.rstrip('/')}/{MANIFEST}/version={uuid.uuid4().hex}")


def recorded_artifacts(spark: SparkSession, base: str) -> DataFrame | None:
    """``(name, path, kind, snapshot, version)`` by the manifest, the newest version of each name; None without one.

    Costs a row for each save, whatever files an artifact has.
    """
    try:
        saved = spark.read.schema(_MANIFEST_SCHEMA).parquet(f"{base.rstrip('/')}/{MANIFEST}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = saved.groupBy("name").agg(F.max_by("version", F.struct("saved", "version")).alias("version"))
    found = newest.withColumn("path", F.concat(F.lit(base.rstrip("/") + "/"), "name"))
    return describe_artifacts(found).select("name", "path", "kind", "snapshot", "version")


def known_artifacts(spark: SparkSession, base: str) -> DataFrame:
    """The recorded artifacts; where nothing was ever recorded, those that lie below ``base``, without a version."""
    recorded = recorded_artifacts(spark, base)
    if recorded is not None:
        return recorded
    return artifact_catalogue(spark, base).withColumn("version", F.lit(None).cast("string"))


def register_artifacts(spark: SparkSession, base: str) -> list[str]:
    """Record the artifacts below ``base`` that were put there by other means; returns their names."""
    there, recorded = artifact_catalogue(spark, base), recorded_artifacts(spark, base)
    new = there if recorded is None else there.join(recorded, "name", "left_anti")
    names = sorted(row["name"] for row in new.select("name").collect())
    for name in names:
        record_artifact(spark, base, name)
    return names


def artifact_kind(name: Column) -> Column:
    """Kind by prefix; NULL for a directory that is no artifact."""
    kind = F.lit(None).cast("string")
    for prefix, value in KINDS.items():
        kind = F.when(name.startswith(prefix), value).otherwise(kind)
    return kind


def artifact_suffix(name: Column) -> Column:
    """The snapshot an artifact belongs to."""
    suffix = F.lit(None).cast("string")
    for prefix in KINDS:
        suffix = F.when(
            name.startswith(prefix), F.substring(name, len(prefix) + 1, F.length(name))
        ).otherwise(suffix)
    return suffix


def describe_artifacts(names: DataFrame, name: str = "name") -> DataFrame:
    """Add ``kind`` and ``snapshot``; other names are ignored."""
    return names.withColumns(
        {"kind": artifact_kind(F.col(name)), "snapshot": artifact_suffix(F.col(name))}
    ).filter("kind IS NOT NULL")


def artifact_catalogue(spark: SparkSession, base: str) -> DataFrame:
    """``(name, path, kind, snapshot)`` of the artifacts below ``base``; file contents are not read."""
    root = re.sub(r"^[a-z0-9]+:/*", "/", base.rstrip("/"))
    try:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no artifact directory at %s", base)
        return spark.createDataFrame([], "name string, path string, kind string, snapshot string")
    names = files.select(
        F.regexp_extract("path", rf"\Q{root}\E/+([^/]+)/", 1).alias("name")
    ).distinct()
    return describe_artifacts(
        names.withColumn("path", F.concat(F.lit(base.rstrip("/") + "/"), "name"))
    )


def load_models(spark: SparkSession, base: str, names: Sequence[str]) -> dict[str, PipelineModel]:
    """The named models that load, by name; what fails is logged and left out.

    Loading a model is a handful of tiny jobs, so several load at a time.
    """

    def load(name: str) -> PipelineModel | None:
        try:
            return PipelineModel.load(f"{base}/{name}")
        except Exception:
            log.exception("could not load %s", name)
            return None

    with ThreadPoolExecutor(8) as pool:
        items = zip(names, pool.map(load, names), strict=True)
        return {name: item for name, item in items if item is not None}
