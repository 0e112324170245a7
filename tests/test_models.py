from pathlib import Path

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from marketloom.operators import features, models
from marketloom.schema import FEATURES, FIT_ROWS
from marketloom.sources import artifacts


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 20, (4, 5))
    return np.vstack([c + rng.normal(0, 1, (60, 5)) for c in centres]) * [1, 10, 1, 1000, 0.1]


@pytest.fixture(scope="module")
def table(spark, points):
    rows = [(i, *map(float, p)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, ["id", *FEATURES]).repartition(4).cache()


def test_moments_and_covariances(table, points):
    moments = {r.feature: r for r in features.feature_moments(table).collect()}
    covariance = np.cov(points.T)
    for i, name in enumerate(FEATURES):
        assert moments[name].row_count == len(points)
        assert moments[name].mean == pytest.approx(points[:, i].mean())
        assert moments[name].std == pytest.approx(points[:, i].std(ddof=1))
    for row in features.covariance_matrix(table).collect():
        i, j = FEATURES.index(row.feature_a), FEATURES.index(row.feature_b)
        assert row.covariance == pytest.approx(covariance[i, j])


def test_scaling_divides_by_the_deviation(table, points):
    scaled = features.scale_features(table, features.fit_scaling(table)).orderBy("id").collect()
    plain = features.scale_by_deviation(table).orderBy("id").collect()
    want = points / points.std(axis=0, ddof=1)
    for i, name in enumerate(FEATURES):
        for rows in (scaled, plain):
            assert [r[f"scaled_{name}"] for r in rows] == pytest.approx(list(want[:, i]))


def test_constant_columns_scale_to_zero(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0)], "a double, b double")
    fitted = features.scale_features(df, features.fit_scaling(df, ["a", "b"]), ["a", "b"])
    plain = features.scale_by_deviation(df, ["a", "b"])
    assert {r.scaled_b for r in fitted.collect()} == {r.scaled_b for r in plain.collect()} == {0.0}


def test_nearest_centre_prefers_the_lower_index_on_ties(spark):
    df = spark.createDataFrame([(0.0, 0.0), (9.0, 9.0), (5.0, 5.0)], "a double, b double")
    centre = features.nearest_centre(["a", "b"], [(10.0, 10.0), (0.0, 0.0), (0.0, 0.0)])
    assert [r.c for r in df.select(centre.alias("c")).collect()] == [1, 0, 0]


def test_clusters(table, points):
    model = models.fit_clusters(table, k=4)
    rows = models.predict_clusters(table, model).orderBy("id").collect()
    scaled = points / points.std(axis=0, ddof=1)
    centres = np.array(model.stages[-1].clusterCenters())
    distances = ((scaled[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert [r.predicted_cluster_id for r in rows] == list(distances.argmin(axis=1))
    assert distances.min(axis=1).sum() < ((scaled - scaled.mean(axis=0)) ** 2).sum()
    assert {r.predicted_cluster_id for r in rows} == set(range(len(centres)))


def test_fewer_points_than_clusters(spark):
    df = spark.createDataFrame([(float(i),) * 5 for i in range(3)], FEATURES)
    assert len(models.fit_clusters(df, k=10).stages[-1].clusterCenters()) == 3


def test_projection(table, points):
    model = models.fit_projection(table)
    components = model.stages[-1].pc.toArray()
    assert components.shape == (5, 3)
    assert components.T @ components == pytest.approx(np.eye(3), abs=1e-9)
    variance = model.stages[-1].explainedVariance.toArray()
    assert list(variance) == sorted(variance, reverse=True)
    rows = models.project(table, model).orderBy("id").collect()
    want = (points / points.std(axis=0, ddof=1)) @ components
    assert np.array([r.transformed_pca_features for r in rows]) == pytest.approx(want)
    eigenvalues = np.sort(np.linalg.eigvalsh(np.corrcoef(points.T)))[::-1][:3]
    assert want.var(axis=0, ddof=1) == pytest.approx(eigenvalues)


def test_pipelines_share_one_scaler_pass(table):
    deviations = models.fit_deviations(table)
    clusters = models.fit_clusters(table, k=2, deviations=deviations)
    projection = models.fit_projection(table, deviations=deviations)
    alone = models.fit_projection(table)
    assert projection.stages[-1].pc == alone.stages[-1].pc
    # The copy for the projection leaves the cluster pipeline's columns alone.
    columns = projection.transform(clusters.transform(table)).columns
    assert columns[-6:] == [*models.CLUSTER_COLUMNS, *models.PROJECTION_COLUMNS]


def test_artifacts_are_replaced_listed_and_loaded(spark, table, tmp_path):
    base = str(tmp_path / "models")
    for k in (2, 3):
        artifacts.save_model(models.fit_clusters(table, k=k), base, "kmeans_model1")
    artifacts.save_model(models.fit_projection(table), base, "pca_model2")
    itemsets = spark.createDataFrame([(["A"], 2)], "items array<string>, freq bigint")
    for _ in range(2):
        artifacts.save_itemsets(itemsets, base, "fpgrowth_results_model3")
    itemsets.write.parquet(f"{base}/notes")
    (tmp_path / "models" / "pca_broken").mkdir()
    (tmp_path / "models" / "pca_broken" / "part-0.parquet").write_text("not a model")
    listed = artifacts.artifact_catalogue(spark, base).orderBy("name").collect()
    assert [(r.name, r.kind, r.snapshot) for r in listed] == [
        ("fpgrowth_results_model3", "fpgrowth", "model3"),
        ("kmeans_model1", "kmeans", "model1"),
        ("pca_broken", "pca", "broken"),
        ("pca_model2", "pca", "model2"),
    ]
    loaded = artifacts.load_models(spark, base, ["kmeans_model1", "pca_broken", "pca_model2"])
    assert sorted(loaded) == ["kmeans_model1", "pca_model2"]
    assert isinstance(loaded["kmeans_model1"], PipelineModel)
    assert len(loaded["kmeans_model1"].stages[-1].clusterCenters()) == 3


def test_missing_artifact_directory(spark, tmp_path):
    assert artifacts.artifact_catalogue(spark, str(tmp_path / "none")).count() == 0


def test_clusters_do_not_depend_on_the_layout(spark):
    """The same centres whatever files and tasks the rows come in; a third of the rows are equal."""
    rows = spark.range(20_000).selectExpr(
        *[f"IF(id % 3 = 0, 1.0D, (id * {7919 + i} % 1000) / 10.0D) AS {c}" for i, c in enumerate(FEATURES)]
    )
    found = []
    for df in (rows.coalesce(1), rows.repartition(2), rows.repartition(8, "Rating"), rows.orderBy("Price")):
        centres = models.fit_clusters(df).stages[-1].clusterCenters()
        found.append([[round(float(v), 9) for v in c] for c in centres])
    assert found[0] == found[1] == found[2] == found[3]


def test_fit_layout_follows_the_vectors():
    assert [models.fit_partitions(n) for n in (0, 1, FIT_ROWS, FIT_ROWS + 1, 100 * FIT_ROWS)] == [1, 1, 1, 2, 100]
    assert models.fit_partitions(FIT_ROWS**2 * 100) == FIT_ROWS * 10


def test_the_same_model_from_any_layout(spark, monkeypatch):
    monkeypatch.setattr(models, "FIT_ROWS", 200)
    rows = spark.range(3_000).select(*[(F.hash("id", F.lit(i)) % 97).cast("double").alias(c) for i, c in enumerate(FEATURES)])
    centres, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts, shuffled in ((1, 2), (7, 8), (13, 31)):
            spark.conf.set("spark.sql.shuffle.partitions", shuffled)
            fitted = models.fit_clusters(rows.repartition(parts), k=6)
            centres.append(np.array(fitted.stages[-1].clusterCenters()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert centres[0] == pytest.approx(centres[1]) and centres[0] == pytest.approx(centres[2])


def test_the_fit_runs_over_a_checkpoint_of_its_layout(spark, monkeypatch):
    """Shuffle and sort are not behind every task of every pass; partitions stay, and the files go at the end."""
    monkeypatch.setattr(models, "FIT_ROWS", 200)
    seen, fit = {}, models.KMeans.fit

    def watched(self, vectors):
        rows = vectors.groupBy(F.spark_partition_id()).count().count()
        # The steps down to the first shuffle, whose metrics each task would send to the driver.
        lineage = vectors.rdd.toDebugString().decode()
        seen.update(rows=vectors.count(), partitions=vectors.rdd.getNumPartitions(), filled=rows, lineage=lineage)
        seen["files"] = vectors._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get()
        return fit(self, vectors)

    monkeypatch.setattr(models.KMeans, "fit", watched)
    rows = spark.range(3_000).select(*[(F.hash("id", F.lit(i)) % 97).cast("double").alias(c) for i, c in enumerate(FEATURES)])
    models.fit_clusters(rows, k=6)
    assert seen["rows"] == rows.distinct().count() > 2_000
    assert seen["partitions"] == seen["filled"] == models.fit_partitions(seen["rows"]) > 10
    assert "ReliableCheckpointRDD" in seen["lineage"] and "ShuffledRowRDD" not in seen["lineage"]
    assert not Path(seen["files"].removeprefix("file:")).exists()
