"""Score requests: JSON bodies with the five features, answered row by row in one scan."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.schema import CLUSTER_PREFIX, FEATURES, PROJECTION_PREFIX

# Outcome of a request and the matching response code.
STATUS_CODES = {"ok": 200, "bad_request": 400, "unknown_model": 404, "invalid": 500}

# Types a feature may have, besides decimals; anything else fails the request.
_NUMBERS = ("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN")
_FALSY = ("0", "0.0", "false", '""', "[]", "{}", "null")


def _listed(body: Column) -> Column:
    """The body as the only element of a JSON array.

    The JSON parser stops after the first value; inside an array, whatever
    follows that value is an error or another element.
    """
    return F.try_parse_json(F.concat(F.lit("["), body, F.lit("]")))


def _only_value(listed: Column, body: Column) -> Column:
    """The one JSON value of a body as a variant; NULL if there is none or more follows it.

    Only a stray bracket could close the array early, so bodies with a bracket
    must parse inside an object as well.
    """
    single = F.try_variant_get(listed, "$[1]", "variant").isNull() & (
        ~body.contains("]")
        | F.try_parse_json(F.concat(F.lit('{"b":'), body, F.lit("}"))).isNotNull()
    )
    return F.when(single, F.try_variant_get(listed, "$[0]", "variant"))


def body_status(parsed: Column) -> Column:
    """``ok``, ``bad_request`` (no JSON, nothing in it, or a feature absent) or ``invalid``.

    Presence and type are told apart: an absent feature is a bad request, while
    NULL, text or nested values in a feature make the request invalid. Integers
    and booleans count as numbers. Duplicate keys and NaN are no JSON here.
    """
    named = F.lit(True)
    typed = F.lit(True)
    listed = F.lit(True)
    spelled = F.lit(True)
    text = F.try_variant_get(parsed, "$", "string")
    entries = F.coalesce(
        F.try_variant_get(parsed, "$", "array<string>"), F.array().cast("array<string>")
    )
    for name in FEATURES:
        value = F.try_variant_get(parsed, f"$.{name}", "variant")
        kind = F.schema_of_variant(value)
        named = named & value.isNotNull()
        typed = typed & (kind.isin(*_NUMBERS) | kind.startswith("DECIMAL"))
        listed = listed & F.array_contains(entries, name)
        spelled = spelled & text.contains(name)
    whole = F.schema_of_variant(parsed)
    status = (
        F.when(parsed.isNull(), "bad_request")
        # Only an object can hold the names; the rest is for everything else.
        .when(named, F.when(typed, "ok").otherwise("invalid"))
        .when(whole.startswith("OBJECT"), "bad_request")
        .when(F.to_json(parsed).isin(*_FALSY), "bad_request")
        .when(whole.startswith("ARRAY"), F.when(~listed, "bad_request"))
        .when(whole == "STRING", F.when(~spelled, "bad_request"))
    )
    return F.coalesce(status, F.lit("invalid"))


def _once(value: Column) -> Column:
    """A generator over one element: evaluated once, however often the column is used."""
    return F.explode(F.array(value))


def parse_requests(requests: DataFrame, prefix: str, known: list[str]) -> DataFrame:
    """Add ``artifact``, ``status``, ``input_features`` and the features as doubles.

    An unknown model comes before anything in the body. Features of requests
    that cannot be scored are 0.0, so that one pass can carry every request.
    """
    suffix = F.coalesce("model", F.lit(""))
    named = requests.withColumn("artifact", F.concat(F.lit(prefix), suffix))
    known_model = F.col("artifact").isin(known)
    body = F.col("body")
    listed = named.withColumn("_list", _once(F.when(known_model, _listed(body))))
    read = listed.withColumn("_json", _once(_only_value(F.col("_list"), body)))
    status = F.when(~known_model, "unknown_model").otherwise(body_status(F.col("_json")))
    judged = read.withColumn("status", _once(status))
    usable = F.col("status") == "ok"
    return judged.withColumns(
        {
            "input_features": F.when(usable, F.col("_json")),
            **{
                name: F.when(
                    usable, F.try_variant_get("_json", f"$.{name}", "double")
                ).otherwise(F.lit(0.0))
                for name in FEATURES
            },
        }
    ).drop("_list", "_json")


def _error(kind: str) -> Column:
    return (
        F.when(
            F.col("status") == "unknown_model",
            F.concat(F.lit(f"{kind} '"), "artifact", F.lit("' not found")),
        )
        .when(
            F.col("status") == "bad_request",
            F.lit("the JSON body must hold all numeric features: " + ", ".join(FEATURES)),
        )
        .when(F.col("status") == "invalid", F.lit("a feature is not a number"))
    )


def model_parameters(
    spark: SparkSession, models: Mapping[str, PipelineModel], prefix: str
) -> DataFrame:
    """``(artifact, scale, vectors)``, a row a model: cluster centres or principal components.

    Made from the models that were loaded, which the driver holds anyway.
    """
    rows = []
    for name, model in sorted(models.items()):
        if not name.startswith(prefix):
            continue
        _, scaler, last = model.stages
        scale = [1 / s if s else 0.0 for s in scaler.std.toArray().tolist()]
        vectors = last.clusterCenters() if prefix == CLUSTER_PREFIX else last.pc.toArray().T
        rows.append((name, scale, [[float(v) for v in vector] for vector in vectors]))
    schema = [("artifact", pa.string()), ("scale", pa.list_(pa.float64())), ("vectors", pa.list_(pa.list_(pa.float64())))]
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    # As an Arrow table it is a local relation, whose size the planner knows.
    return spark.createDataFrame(
        pa.table([pa.array(c, kind) for c, (_, kind) in zip(columns, schema, strict=True)], pa.schema(schema))
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def nearest_vector(scaled: Column, vectors: Column) -> Column:
    """Place of the vector with the least squared distance; a tie goes to the first."""
    distances = F.transform(
        vectors, lambda v: _sum(F.zip_with(scaled, v, lambda x, c: (x - c) * (x - c)))
    )
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def projection(scaled: Column, vectors: Column) -> Column:
    return F.transform(vectors, lambda v: _sum(F.zip_with(scaled, v, lambda x, c: x * c)))


def _score(
    requests: DataFrame,
    models: Mapping[str, PipelineModel],
    prefix: str,
    apply: Callable[[Column, Column], Column],
    result: str,
) -> DataFrame:
    """Answer every request with the model it names.

    Models are rows that requests are joined with by name, so the plan is the same
    for any number of them; a row is kept whichever way it ends, and ``result``
    is set only where the status is ``ok``.
    """
    parameters = model_parameters(requests.sparkSession, models, prefix)
    base = [*requests.columns, "artifact", "status", "input_features"]
    known = sorted(name for name in models if name.startswith(prefix))
    parsed = parse_requests(requests, prefix, known).join(parameters, "artifact", "left")
    scaled = F.zip_with(F.array(*FEATURES), F.col("scale"), lambda x, s: x * s)
    usable = F.col("status") == "ok"
    scored = parsed.withColumn("_scaled", _once(F.when(usable, scaled)))
    scored = scored.withColumn(result, _once(F.when(usable, apply(F.col("_scaled"), F.col("vectors")))))
    response = F.to_json(
        F.struct(
            F.col("artifact").alias("model_used"),
            "input_features",
            F.col(result),
        )
    )
    return (
        scored.select(*base, result)
        .withColumn("error", _error("model"))
        .withColumn("code", status_code(F.col("status")))
        .withColumn("response", F.when(usable, response).otherwise(F.to_json(F.struct("error"))))
    )


def status_code(status: Column) -> Column:
    code = F.lit(None).cast("int")
    for name, value in STATUS_CODES.items():
        code = F.when(status == name, value).otherwise(code)
    return code


def score_clusters(requests: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """Requests ``(model, body, …)`` with ``predicted_cluster_id``, ``status`` and ``response``."""
    return _score(requests, models, CLUSTER_PREFIX, nearest_vector, "predicted_cluster_id")


def score_projections(requests: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """Requests with ``transformed_pca_features``, ``status`` and ``response``."""
    return _score(requests, models, PROJECTION_PREFIX, projection, "transformed_pca_features")


def itemset_rows(itemsets: DataFrame, results_used: str) -> DataFrame:
    """One JSON line per itemset; stays distributed however many there are."""
    return itemsets.select(
        F.to_json(
            F.struct(
                F.lit(results_used).alias("results_used"),
                F.col("items").cast("array<string>").alias("items"),
                F.col("freq").cast("long").alias("freq"),
            )
        ).alias("response")
    )


def split_by_catalogue(
    requests: DataFrame, catalogue: DataFrame, kind: str
) -> DataFrame:
    """Requests with ``known``: whether the catalogue holds an artifact of ``kind`` for them.

    A left join; the catalogue is broadcast only if its measured size allows it,
    and otherwise a hot model is split by the adaptive skew join.
    """
    held = (
        catalogue.filter(F.col("kind") == kind)
        .select(F.col("snapshot").alias("model"), F.col("name").alias("artifact"))
        .distinct()
    )
    return requests.join(held, "model", "left").withColumn("known", F.col("artifact").isNotNull())

