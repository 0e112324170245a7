import json
from concurrent.futures import ThreadPoolExecutor

import pytest

from marketloom.operators import models, scoring
from marketloom.operators.cleaning import FEATURES
from marketloom.plans import serving
from marketloom.plans.serving import Scorer, start_scoring
from marketloom.sources import artifacts

GOOD = {"Rating": 3.25, "Reviews": 812.0, "Size": 17.75, "Installs": 64000.0, "Price": 2.5}


def body(**changes):
    return json.dumps({**GOOD, **changes})


def without(name):
    return json.dumps({k: v for k, v in GOOD.items() if k != name})


CASES = [
    ("model1", body(), "ok"),
    ("model1", body(Rating=4), "ok"),
    ("model1", body(Rating=True), "ok"),
    ("model1", body(Rating=1e3, extra={"a": [1]}), "ok"),
    ("model1", "  " + body() + " \n", "ok"),
    ("model9", body(), "unknown_model"),
    ("model9", "", "unknown_model"),
    (None, body(), "unknown_model"),
    ("model1", None, "bad_request"),
    ("model1", "", "bad_request"),
    ("model1", "   ", "bad_request"),
    ("model1", "{}", "bad_request"),
    ("model1", "[]", "bad_request"),
    ("model1", "null", "bad_request"),
    ("model1", "0", "bad_request"),
    ("model1", "false", "bad_request"),
    ("model1", '""', "bad_request"),
    ("model1", '"text"', "bad_request"),
    ("model1", "[1, 2]", "bad_request"),
    ("model1", "{not json", "bad_request"),
    ("model1", body() + "}", "bad_request"),
    ("model1", body() + "," + body(), "bad_request"),
    ("model1", body() + "] [1", "bad_request"),
    *[("model1", without(name), "bad_request") for name in FEATURES],
    *[("model1", body(**{name: None}), "invalid") for name in FEATURES],
    ("model1", body(Size="30M"), "invalid"),
    ("model1", body(Size="30.5"), "invalid"),
    ("model1", body(Price=[1]), "invalid"),
    ("model1", body(Price={"a": 1}), "invalid"),
    ("model1", json.dumps(list(GOOD)), "invalid"),
    ("model1", json.dumps(" ".join(GOOD)), "invalid"),
    ("model1", "7", "invalid"),
    ("model1", "true", "invalid"),
]


@pytest.fixture(scope="module")
def fitted(spark):
    rows = [(float(i % 6), i * 1e5, float(i % 40), i * 1e6, float(i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, FEATURES)
    return {
        "kmeans_model1": models.fit_clusters(df, k=3),
        "kmeans_model2": models.fit_clusters(df, k=5),
        "pca_model1": models.fit_projection(df),
    }


@pytest.fixture(scope="module")
def requests(spark):
    rows = [(i, model, text) for i, (model, text, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "id int, model string, body string").repartition(3)


def test_outcomes(requests, fitted):
    rows = scoring.score_clusters(requests, fitted).orderBy("id").collect()
    assert [(CASES[r.id][1], r.status) for r in rows] == [(c[1], c[2]) for c in CASES]
    for row in rows:
        answer = json.loads(row.response)
        assert row.code == scoring.STATUS_CODES[row.status]
        if row.status == "ok":
            assert row.error is None and answer["model_used"] == "kmeans_model1"
            assert answer["input_features"] == json.loads(row.body)
            assert answer["predicted_cluster_id"] == row.predicted_cluster_id
        else:
            assert answer == {"error": row.error} and row.predicted_cluster_id is None


def test_each_request_gets_its_own_model(spark, fitted):
    rows = [(i, f"model{1 + i % 2}", body(Reviews=i * 1e5, Installs=i * 1e6)) for i in range(60)]
    requests = spark.createDataFrame(rows, "id int, model string, body string")
    got = scoring.score_clusters(requests, fitted).orderBy("id").collect()
    for name in ("model1", "model2"):
        mine = [r for r in rows if r[1] == name]
        values = [tuple(float(json.loads(r[2])[f]) for f in FEATURES) for r in mine]
        direct = models.predict_clusters(
            spark.createDataFrame(values, FEATURES).coalesce(1), fitted[f"kmeans_{name}"]
        )
        assert [r.predicted_cluster_id for r in direct.collect()] == [
            r.predicted_cluster_id for r in got if r.model == name
        ]


def test_projections(requests, fitted):
    rows = scoring.score_projections(requests, fitted).orderBy("id").collect()
    assert [r.status for r in rows] == [c[2] for c in CASES]
    for row in rows:
        if row.status == "ok":
            assert len(row.transformed_pca_features) == 3
            answer = json.loads(row.response)
            assert answer["model_used"] == "pca_model1"
            assert answer["transformed_pca_features"] == pytest.approx(row.transformed_pca_features)


def test_no_models_at_all(requests):
    assert {r.status for r in scoring.score_clusters(requests, {}).collect()} == {"unknown_model"}


def test_one_scan_for_all_models(spark, fitted, tmp_path):
    spark.createDataFrame([("model1", body())], "model string, body string").write.parquet(
        str(tmp_path / "r")
    )
    scored = scoring.score_clusters(spark.read.parquet(str(tmp_path / "r")), fitted)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "hashpartitioning" not in plan


def test_stream_of_requests(spark, fitted, tmp_path):
    rows = [(i, model, text) for i, (model, text, _) in enumerate(CASES)]
    schema = "id int, model string, body string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    answers = scoring.score_clusters(stream, fitted).select("id", "status")
    (
        answers.writeStream.option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .format("parquet")
        .start(str(tmp_path / "out"))
        .awaitTermination()
    )
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect()
    assert [r.status for r in got] == [c[2] for c in CASES]


def test_itemset_answers(spark, tmp_path):
    rows = [(["GAME"], 45), (["FAMILY"], 50), (["FAMILY", "GAME"], 10)]
    itemsets = spark.createDataFrame(rows, "items array<string>, freq bigint")
    artifacts.save_itemsets(itemsets, str(tmp_path), "fpgrowth_results_model3")
    scorer = Scorer(spark, str(tmp_path))
    lines = [json.loads(r.response) for r in scorer.itemset_response("model3").collect()]
    assert lines == [
        {"results_used": "fpgrowth_results_model3", "items": items, "freq": freq}
        for items, freq in ((["FAMILY"], 50), (["GAME"], 45), (["FAMILY", "GAME"], 10))
    ]
    assert [r.freq for r in scorer.itemsets("model3").collect()] == [50, 45, 10]
    missing = scorer.itemset_response("model7").first()
    assert (missing.status, missing.code) == ("unknown_model", 404)
    with pytest.raises(KeyError):
        scorer.itemsets("model7")


def test_served_values_are_those_of_the_pipelines(spark, fitted):
    """Scoring joins requests with centres and components; the saved pipelines must say the same."""
    rows = [(i, "model1", json.dumps({c: (i * (7 + k)) % 50 / 3 for k, c in enumerate(FEATURES)})) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, model string, body string")
    parsed = scoring.parse_requests(df, "kmeans_", ["kmeans_model1"])
    own = {r.id: r.predicted_cluster_id for r in models.predict_clusters(parsed.select("id", *FEATURES), fitted["kmeans_model1"]).collect()}
    assert {r.id: r.predicted_cluster_id for r in scoring.score_clusters(df, fitted).collect()} == own
    own = {r.id: r.transformed_pca_features for r in models.project(parsed.select("id", *FEATURES), fitted["pca_model1"]).collect()}
    for r in scoring.score_projections(df, fitted).collect():
        assert r.transformed_pca_features == pytest.approx(own[r.id])


def test_only_named_models_are_loaded(spark, fitted, tmp_path):
    for name in ("kmeans_model1", "kmeans_model2"):
        artifacts.save_model(fitted["kmeans_model1"], str(tmp_path), name)
    scorer = Scorer(spark, str(tmp_path))
    named = spark.createDataFrame([("model2", body()), ("model9", body())], "model string, body string")
    assert sorted(r.status for r in scorer.clusters(named).collect()) == ["ok", "unknown_model"]
    assert list(scorer.models) == ["kmeans_model2"]


def answered(spark, tmp_path, delivery, rows):
    """Deliver requests, run the scoring stream, and give back the answers of this delivery by id."""
    spark.createDataFrame(rows, "request_id string, model string, body string").write.mode("append").json(str(tmp_path / "in"))
    stream = spark.readStream.schema("request_id string, model string, body string").json(str(tmp_path / "in"))
    start_scoring(stream, str(tmp_path / "models"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).filter(f"micro = {delivery}").collect()
    return {r.request_id: (r.code, r.predicted_cluster_id) for r in got}


def test_a_stream_is_answered_by_the_models_of_the_moment(spark, fitted, tmp_path):
    base, good = str(tmp_path / "models"), body()
    model = fitted["kmeans_model1"]
    artifacts.save_model(model, base, "kmeans_model1")
    own = models.predict_clusters(spark.createDataFrame([tuple(json.loads(good)[c] for c in FEATURES)], FEATURES), model).first().predicted_cluster_id
    rows = [("a", "model1", good), ("b", "model2", good), ("c", "model1", "{}")]
    assert answered(spark, tmp_path, 0, rows) == {"a": (200, own), "b": (404, None), "c": (400, None)}
    one = models.fit_clusters(spark.createDataFrame([(1.0, 2.0, 3.0, 4.0, 5.0)] * 3, FEATURES), k=2)
    artifacts.save_model(one, base, "kmeans_model1")
    artifacts.save_model(model, base, "kmeans_model2")
    assert answered(spark, tmp_path, 1, [("d", "model1", good), ("e", "model2", good)]) == {"d": (200, 0), "e": (200, own)}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_replaced_models_are_loaded_again(spark, fitted, tmp_path, monkeypatch):
    loaded = []
    load = artifacts.load_models
    monkeypatch.setattr(serving, "load_models", lambda s, b, names: loaded.append(list(names)) or load(s, b, names))
    artifacts.save_model(fitted["kmeans_model1"], str(tmp_path), "kmeans_model1")
    scorer = Scorer(spark, str(tmp_path))
    requests = spark.createDataFrame([("model1", body())], "model string, body string")
    for _ in range(2):
        assert scorer.clusters(requests).first().status == "ok"
    artifacts.save_model(fitted["kmeans_model1"], str(tmp_path), "kmeans_model1")
    assert scorer.clusters(requests).first().status == "ok"
    assert [names for names in loaded if names] == [["kmeans_model1"], ["kmeans_model1"]]


def test_artifacts_are_recorded(spark, tmp_path):
    base = str(tmp_path / "models")
    assert artifacts.recorded_artifacts(spark, base) is None and artifacts.known_artifacts(spark, base).count() == 0
    itemsets = spark.createDataFrame([(["A"], 2)], "items array<string>, freq bigint")
    itemsets.write.parquet(f"{base}/fpgrowth_results_old")
    assert [(r.name, r.version) for r in artifacts.known_artifacts(spark, base).collect()] == [("fpgrowth_results_old", None)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: artifacts.save_itemsets(itemsets, base, f"fpgrowth_results_{n}"), range(4)))
    first = {r.name: r.version for r in artifacts.recorded_artifacts(spark, base).collect()}
    assert sorted(first) == [f"fpgrowth_results_{n}" for n in range(4)]
    artifacts.save_itemsets(itemsets, base, "fpgrowth_results_0")
    second = {r.name: r.version for r in artifacts.recorded_artifacts(spark, base).collect()}
    assert {n for n in first if first[n] != second[n]} == {"fpgrowth_results_0"}
    assert artifacts.register_artifacts(spark, base) == ["fpgrowth_results_old"]
    assert artifacts.register_artifacts(spark, base) == []
    listed = artifacts.recorded_artifacts(spark, base).collect()
    assert {(r.name, r.path, r.kind, r.snapshot) for r in listed if r.snapshot == "old"} == {
        ("fpgrowth_results_old", f"{base}/fpgrowth_results_old", "fpgrowth", "old")
    }
