"""Feature statistics, scaling, and fixed-centre assignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.schema import FEATURES


def feature_moments(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Per feature: count, mean and sample standard deviation, from one pass."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.count(c).alias("row_count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
            ).alias(f"s{i}")
            for i, c in enumerate(columns)
        ]
    )
    return stats.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(columns))])))


def covariance_matrix(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Upper triangle of the sample covariance matrix, from one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    stats = df.agg(
        *[
            F.struct(
                F.lit(a).alias("feature_a"),
                F.lit(b).alias("feature_b"),
                F.covar_samp(a, b).alias("covariance"),
            ).alias(f"s{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return stats.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(pairs))])))


def assembler(columns: Sequence[str] = FEATURES, output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output)


def scaler(source: str = "features", output: str = "scaled_features") -> StandardScaler:
    """Divide by the sample standard deviation, no centring; constant columns become 0."""
    return StandardScaler(inputCol=source, outputCol=output, withStd=True, withMean=False)


def fit_scaling(df: DataFrame, columns: Sequence[str] = FEATURES) -> PipelineModel:
    return Pipeline(stages=[assembler(columns), scaler()]).fit(df)


def scale_features(
    df: DataFrame, model: PipelineModel, columns: Sequence[str] = FEATURES
) -> DataFrame:
    """Scaled values as columns ``scaled_<name>`` beside the input columns."""
    scaled = model.transform(df).withColumn("_scaled", vector_to_array("scaled_features"))
    return scaled.select(
        *df.columns,
        *[F.col("_scaled")[i].alias(f"scaled_{c}") for i, c in enumerate(columns)],
    )


def scale_by_deviation(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """The same scaling in plain columns; the deviations come from one shared subquery."""
    deviations = df.agg(*[F.stddev_samp(c).alias(c) for c in columns])
    return df.withColumns(
        {
            f"scaled_{c}": F.coalesce(
                F.col(c) / F.nullif(deviations.select(c).scalar(), F.lit(0.0)), F.lit(0.0)
            )
            for c in columns
        }
    )


def squared_distance(columns: Sequence[str], centre: Sequence[float]) -> Column:
    gaps = [F.col(c) - F.lit(float(v)) for c, v in zip(columns, centre, strict=True)]
    total = gaps[0] * gaps[0]
    for gap in gaps[1:]:
        total = total + gap * gap
    return total


def nearest_centre(columns: Sequence[str], centres: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest of the given centres; a tie goes to the lower index.

    The centres are literals of the projection: no join, no shuffle.
    """
    candidates = [
        F.struct(squared_distance(columns, centre).alias("distance"), F.lit(i).alias("centre"))
        for i, centre in enumerate(centres)
    ]
    return F.array_min(F.array(*candidates))["centre"]
