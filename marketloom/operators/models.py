"""Cluster and projection pipelines over the scaled features."""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScalerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.operators.features import assembler, scaler
from marketloom.schema import CLUSTERS, COMPONENTS, FEATURES, FIT_DIGITS, FIT_ROWS, SEED
from marketloom.session import checkpointed, staged, staging

# Column names inside the saved pipelines.
CLUSTER_COLUMNS = ("features_kmeans", "scaledFeatures_kmeans", "prediction_kmeans")
_WEIGHT = "_weight"
PROJECTION_COLUMNS = ("features_pca", "scaledFeatures_pca", "pcaFeatures")


def fit_deviations(df: DataFrame, columns: Sequence[str] = FEATURES) -> StandardScalerModel:
    """The scaler's one pass over the data; both pipelines can use the result."""
    raw, scaled, _ = CLUSTER_COLUMNS
    return scaler(raw, scaled).fit(assembler(columns, raw).transform(df))


def fit_partitions(vectors: int) -> int:
    """Partitions for a fit over so many distinct vectors.

    ``FIT_ROWS`` vectors each; beyond the square of that, partitions and the
    vectors in one grow alike.
    """
    return max(1, -(-vectors // max(FIT_ROWS, isqrt(vectors))))


def fit_clusters(
    df: DataFrame,
    columns: Sequence[str] = FEATURES,
    k: int = CLUSTERS,
    seed: int = SEED,
    deviations: StandardScalerModel | None = None,
) -> PipelineModel:
    """Assemble, scale, k-means. The fit keeps its own copy of the scaled vectors.

    The fit starts from random rows of each partition, so equal vectors are
    counted first and laid out by value over sorted partitions, as many as the
    number of distinct vectors asks for: the model then depends on the data and
    the seed, not on files or cores, and a hot vector is one weighted row. They
    are staged meanwhile, as the estimator runs its input more than once, and the
    laid-out vectors are checkpointed: some fifty stages go over every partition.

    The row solver takes data with fewer distinct points than ``k`` (the block
    solver fails on it) and needs no extra pass to measure sparsity.
    """
    raw, scaled, prediction = CLUSTER_COLUMNS
    assemble = assembler(columns, raw)
    scale = deviations or fit_deviations(df, columns)
    kmeans = KMeans(
        featuresCol=scaled, predictionCol=prediction, k=k, seed=seed, solver="row", weightCol=_WEIGHT
    )
    with staging(df.sparkSession):
        counted = df.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias(_WEIGHT))
        distinct = staged(counted, "distinct-vectors")
        laid_out = distinct.repartition(fit_partitions(distinct.count()), *columns).sortWithinPartitions(*columns)
        # Deviations differ in their last digits between layouts, which would decide ties between centres.
        steady = F.transform(vector_to_array(scaled), lambda x: F.round(x, FIT_DIGITS))
        vectors = scale.transform(assemble.transform(laid_out)).select(array_to_vector(steady).alias(scaled), _WEIGHT)
        return PipelineModel([assemble, scale, kmeans.fit(checkpointed(vectors))])


def fit_projection(
    df: DataFrame,
    columns: Sequence[str] = FEATURES,
    k: int = COMPONENTS,
    deviations: StandardScalerModel | None = None,
) -> PipelineModel:
    """Assemble, scale, principal components of the scaled features."""
    raw, scaled, projected = PROJECTION_COLUMNS
    assemble = assembler(columns, raw)
    scale = (deviations or fit_deviations(df, columns)).copy()
    scale.setInputCol(raw).setOutputCol(scaled)
    pca = PCA(k=k, inputCol=scaled, outputCol=projected)
    vectors = scale.transform(assemble.transform(df)).select(scaled)
    return PipelineModel([assemble, scale, pca.fit(vectors)])


def predict_clusters(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Input columns and ``predicted_cluster_id``."""
    return model.transform(df).select(
        *df.columns, F.col(CLUSTER_COLUMNS[2]).cast("int").alias("predicted_cluster_id")
    )


def project(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Input columns and ``transformed_pca_features`` as an array of doubles."""
    return model.transform(df).select(
        *df.columns, vector_to_array(PROJECTION_COLUMNS[2]).alias("transformed_pca_features")
    )
