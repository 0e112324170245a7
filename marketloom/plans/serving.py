"""Answers from saved artifacts: clusters, projections and itemsets by snapshot."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketloom.operators.scoring import (
    itemset_rows,
    score_clusters,
    score_projections,
    status_code,
)
from marketloom.schema import CLUSTER_PREFIX, ITEMSET_PREFIX, PROJECTION_PREFIX
from marketloom.sources.artifacts import known_artifacts, load_models


class Scorer:
    """The three questions that the artifacts of one directory answer.

    Models are loaded when first named, and again when a newer version of theirs
    has been recorded.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self.models: dict[str, PipelineModel] = {}
        self.versions: dict[str, str | None] = {}

    def clusters(self, requests: DataFrame) -> DataFrame:
        """``requests`` is a batch or a stream of ``(model, body, …)``."""
        return self._scored(requests, CLUSTER_PREFIX, score_clusters)

    def projections(self, requests: DataFrame) -> DataFrame:
        return self._scored(requests, PROJECTION_PREFIX, score_projections)

    def itemsets(self, suffix: str) -> DataFrame:
        """``(items, freq)``, most frequent first; KeyError for an unknown snapshot."""
        name = ITEMSET_PREFIX + suffix
        if not self._saved(name):
            raise KeyError(name)
        found = self.spark.read.parquet(f"{self.base}/{name}").select("items", "freq")
        return found.orderBy(F.desc("freq"), "items")

    def itemset_response(self, suffix: str) -> DataFrame:
        """``(status, code, response)``: one JSON line per itemset, most frequent first."""
        name = ITEMSET_PREFIX + suffix
        if self._saved(name):
            answer = itemset_rows(self.itemsets(suffix), name).withColumn("status", F.lit("ok"))
        else:
            error = F.to_json(F.struct(F.lit(f"result '{name}' not found").alias("error")))
            answer = self.spark.range(1).select(
                F.lit("unknown_model").alias("status"), error.alias("response")
            )
        return answer.select("status", status_code(F.col("status")).alias("code"), "response")

    def _saved(self, name: str) -> bool:
        return not known_artifacts(self.spark, self.base).filter(F.col("name") == name).isEmpty()

    def _scored(
        self, requests: DataFrame, prefix: str, score: Callable[..., DataFrame]
    ) -> DataFrame:
        """Load the models that the requests name; for a stream, whose names are to come, all of the kind."""
        names = known_artifacts(self.spark, self.base).filter(F.col("name").startswith(prefix))
        if not requests.isStreaming:
            named = requests.select(F.concat(F.lit(prefix), "model").alias("name")).distinct()
            names = names.join(named, "name", "left_semi")
        wanted = {row["name"]: row["version"] for row in names.select("name", "version").orderBy("name").collect()}
        stale = [name for name in wanted if name not in self.models or self.versions.get(name) != wanted[name]]
        for name in stale:
            self.models.pop(name, None)
        self.models |= load_models(self.spark, self.base, stale)
        self.versions |= {name: wanted[name] for name in stale}
        return score(requests, {name: self.models[name] for name in wanted if name in self.models})


def start_scoring(
    requests: DataFrame, base: str, output: str, checkpoint: str, kind: str = "clusters", every: str | None = None
) -> StreamingQuery:
    """Answer a stream of requests: all there are, or a micro-batch ``every`` interval.

    Every micro-batch is answered by the artifacts that are recorded when it
    begins, so a model saved or replaced meanwhile answers the next one. Answers go to
    ``micro=<id>`` below ``output``; a retry replaces them, perhaps by newer models.
    """
    scorer = Scorer(requests.sparkSession, base)
    answer = {"clusters": scorer.clusters, "projections": scorer.projections}[kind]

    def write(delivered: DataFrame, micro_batch: int) -> None:
        answered = answer(delivered).drop("input_features")
        answered.write.mode("overwrite").parquet(f"{output.rstrip('/')}/micro={micro_batch}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    started = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return started.trigger(**trigger).start()
