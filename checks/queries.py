"""One query per operator group, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.samples import app_rows, dealt, event_messages, event_records, table
from marketloom.operators import batching, cleaning, features, mining, models, scoring, snapshots
from marketloom.operators.wire import (
    accepted_records,
    encode_records,
    field,
    judged_records,
    parse_messages,
    project_fields,
    rejected_records,
)
from marketloom.plans.ingest import dataset_messages, ingest_topic
from marketloom.plans.refresh import Summaries
from marketloom.plans.serving import Scorer, start_scoring
from marketloom.plans.training import train_from_store, train_snapshots
from marketloom.schema import (
    BATCH_COLUMNS,
    CLUSTER_PREFIX,
    FEATURES,
    ITEMSET_PREFIX,
    PROJECTION_PREFIX,
    SNAPSHOTS,
    WIRE_FIELD_COUNT,
)
from marketloom.session import remove_paths, shared_dir, staged
from marketloom.sources import artifacts, batches
from marketloom.sources.raw import read_rows
from marketloom.sources.topic import as_messages, read_topic, stream_topic, write_topic
from marketloom.streaming.ingest import (
    IngestStore,
    compact_in_place,
    export_batch_files,
    ingest_micro_batch,
    run_ingest,
)

EVENT_BATCH = 1_000
ORDER_BATCH = 3_000
PART_BATCH = 500
# Rows per numbering bucket: small enough that the test tables fill more than one.
BUCKET = 1 << 13
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CENTRES = [
    (5.0, 5_000.0, 0.01, 0.01),
    (15.0, 20_000.0, 0.03, 0.02),
    (25.0, 35_000.0, 0.05, 0.04),
    (35.0, 60_000.0, 0.07, 0.06),
    (45.0, 90_000.0, 0.09, 0.08),
]
BASKET_SUPPORT = 0.004
BASKET_CONFIDENCE = 0.14
POSITION_NAMES = [f"c{i}" for i in range(WIRE_FIELD_COUNT)]


def rounded(value: Column, digits: int = 6) -> Column:
    """Rounded, without the sign of a zero."""
    return F.round(value, digits) + F.lit(0.0)


# --- wire ---------------------------------------------------------------------


def wire_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_records(event_records(spark, sf_dir), POSITION_NAMES, keep=["event_id"])
    parsed = parse_messages(encoded)
    return parsed.filter("reason IS NULL").select(
        "event_id", *[field(i).alias(c) for i, c in enumerate(POSITION_NAMES)]
    )


def wire_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, with their quotes and line breaks, through the wire."""
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    encoded = encode_records(table(spark, sf_dir, "documents"), names)
    parsed = parse_messages(encoded, arity=len(names)).filter("reason IS NULL")
    return parsed.select(
        field(0).cast("long").alias("doc_id"),
        field(1).alias("text"),
        field(2).alias("lang"),
        field(3).alias("source"),
        field(4).cast("long").alias("n_chars"),
    )


def _conversation_files(spark: SparkSession, sf_dir: str) -> str:
    path = shared_dir(spark, "raw-csv")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows.write.options(header=True, escape='"', emptyValue="").csv(path)
    return path


def _conversation_fields(df: DataFrame) -> DataFrame:
    return df.select(
        field(0).cast("long").alias("conv_id"),
        field(1).cast("long").alias("turn"),
        field(2).alias("role"),
        field(3).alias("text"),
    )


def raw_csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as CSV files, published as messages and parsed, whatever lines they span."""
    path = _conversation_files(spark, sf_dir)
    parsed = parse_messages(dataset_messages(spark, path, "conversations", arity=4), arity=4)
    return _conversation_fields(parsed.filter("reason IS NULL"))


def dataset_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as a file for each role, published, and taken in: place and batch of every row."""
    base = shared_dir(spark, "dataset")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", "role")
    by_role = rows.repartition("role").sortWithinPartitions("role", "conv_id", "turn")
    by_role.write.partitionBy("role").options(header=True, escape='"', emptyValue="").csv(f"{base}/csv")
    write_topic(dataset_messages(spark, f"{base}/csv", "conversations", arity=3), f"{base}/topic")
    store = ingest_topic(
        read_topic(spark, f"{base}/topic"),
        f"{base}/out",
        batch_size=EVENT_BATCH,
        arity=3,
        positions={"conv_id": 0, "turn": 1},
    )
    return store.read_batches(spark).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "partition",
        "offset",
        "batch_no",
    )


def raw_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files, known to be well formed, through Spark's own reader."""
    return _conversation_fields(read_rows(spark, _conversation_files(spark, sf_dir), arity=4))


def arity_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judged_records(parse_messages(event_messages(spark, sf_dir)), ["offset"])
    return rejected_records(judged, ["offset"]).drop("value")


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judged_records(parse_messages(event_messages(spark, sf_dir)))
    return judged.groupBy(F.coalesce("reason", F.lit("accepted")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("messages")
    )


def _accepted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_messages(event_messages(spark, sf_dir))
    return project_fields(parsed, ["partition", "offset"])


def project_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted_events(spark, sf_dir).withColumnRenamed("offset", "event_id").drop("partition")


# --- batches and snapshots ----------------------------------------------------


def _event_batches(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    """Numbering reads its input twice, so the parsed records are staged first."""
    accepted = staged(_accepted_events(spark, sf_dir), "accepted")
    return batching.number_batches(
        accepted, EVENT_BATCH, bucket_offsets=BUCKET, **settings
    ).withColumnRenamed("offset", "event_id")


def count_window_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_batches(spark, sf_dir).select("event_id", "row_no", "batch_no")


def remainder_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = _event_batches(spark, sf_dir, mark_remainder=True)
    return numbered.filter("is_remainder").select("event_id", "batch_no")


def batch_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of event batches, ranked by number and by text."""
    events = table(spark, sf_dir, "events").select("ts", F.col("event_id").alias("offset"))
    numbered = batching.number_batches(events, 100, partition=None, bucket_offsets=BUCKET)
    per_batch = numbered.groupBy("batch_no").agg(F.max("ts").alias("written"))
    names = per_batch.select(
        snapshots.batch_file_name(F.col("batch_no"), F.col("written")).alias("file_name")
    )
    by_number = snapshots.rank_batches(names, "numeric").select(
        "file_name", "batch_no", F.col("batch_rank").alias("numeric_rank")
    )
    by_text = snapshots.rank_batches(names, "lexical").select(
        "file_name", F.col("batch_rank").alias("lexical_rank")
    )
    return by_number.join(by_text, "file_name")


def batch_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event batches exported as CSV files after each of two deliveries, the second adding only new ones."""
    base = shared_dir(spark, "batch-files")
    for place, delivery in enumerate(_deliveries(spark, sf_dir)):
        write_topic(delivery, f"{base}/topic")
        store = run_ingest(
            stream_topic(spark, f"{base}/topic"), f"{base}/out", f"{base}/checkpoint", batch_size=EVENT_BATCH
        )
        export_batch_files(spark, store, f"{base}/csv", final=place == 1)
    rows = snapshots.parse_batch_names(batches.read_batch_files(spark, f"{base}/csv"))
    return rows.select(*BATCH_COLUMNS, "batch_no", "is_remainder")


def export_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All event batches exported, two in the middle lost, and exported again: what the files hold then."""
    path, store = shared_dir(spark, "batch-files"), _whole_topic(spark, sf_dir)
    export_batch_files(spark, store, path, final=True)
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.csv").load(path)
    named = files.select("path", F.regexp_extract("path", r"batch_file=batch_(\d+)_", 1).cast("long").alias("batch_no"))
    middle = named.agg(F.floor(F.max("batch_no") / 2).alias("n")).first()["n"]
    lost = named.filter(F.col("batch_no").between(middle, middle + 1)).select("path").collect()
    remove_paths(spark, [row["path"].rsplit("/", 1)[0] for row in lost])
    export_batch_files(spark, store, path, final=True)
    rows = snapshots.parse_batch_names(batches.read_batch_files(spark, path))
    return rows.select(*BATCH_COLUMNS, "batch_no", "is_remainder")


def cumulative_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("offset"), "o_custkey", "o_totalprice"
    )
    numbered = batching.number_batches(orders, ORDER_BATCH, partition=None, bucket_offsets=BUCKET)
    tiered = numbered.withColumn("tier", snapshots.tier_of_rank(F.col("batch_no")))
    return snapshots.cumulative_snapshots(tiered).select(
        "snapshot", F.col("offset").alias("o_orderkey"), "o_custkey", "o_totalprice", "batch_no"
    )


# --- cleaning -----------------------------------------------------------------


def clean_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_features(app_rows(spark, sf_dir)).select("id", *FEATURES)


def _filled(spark: SparkSession, sf_dir: str, nan: str = "missing") -> DataFrame:
    return cleaning.fill_missing(cleaning.clean_features(app_rows(spark, sf_dir)), nan=nan)


def mean_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(spark, sf_dir).select("id", *[rounded(F.col(c)).alias(c) for c in FEATURES])


def category_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled(spark, sf_dir).select("id", "Category")


def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = cleaning.clean_features(app_rows(spark, sf_dir))
    return cleaning.drop_incomplete(cleaned).select("id", "Category", *FEATURES)


def propagated_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With NaN left in the mean, rows that needed the mean are dropped."""
    return cleaning.drop_incomplete(_filled(spark, sf_dir, nan="propagate")).select(
        "id", *FEATURES, "Category"
    )


def row_quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile that staging the cleaned rows has found on its way: one row, no pass of its own."""
    cleaned = cleaning.clean_features(app_rows(spark, sf_dir)).select("id", *FEATURES, "Category")
    noted, found = cleaning.observed(cleaned, cleaning.profile_columns(), "profile")
    staged(noted, "profiled")
    return spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in found.get.items()])


def _tiered_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    apps = app_rows(spark, sf_dir).withColumnRenamed("id", "offset")
    numbered = batching.number_batches(apps, PART_BATCH, partition=None, bucket_offsets=BUCKET)
    return numbered.withColumn("tier", snapshots.tier_of_rank(F.col("batch_no")))


def snapshot_mean_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each snapshot filled with its own mean; the three means come from one pass."""
    cleaned = staged(cleaning.clean_features(_tiered_apps(spark, sf_dir)), "cleaned")
    fills = cleaning.snapshot_statistics(cleaned)
    cumulated = snapshots.cumulative_snapshots(cleaned)
    mean = cleaning.snapshot_fill(fills, F.col("snapshot"))
    return cleaning.fill_missing(cumulated, mean).select(
        "snapshot", F.col("offset").alias("id"), rounded(F.col("Rating")).alias("Rating")
    )


# --- refresh from summaries, and the guards of training ------------------------


def _refreshed_apps(spark: SparkSession, sf_dir: str) -> Summaries:
    """App rows in two deliveries, each of which is summarised before the next one comes."""
    base = shared_dir(spark, "refresh")
    names = ["App", "Category", *FEATURES]
    apps = app_rows(spark, sf_dir)
    messages = as_messages(encode_records(apps, names, keep=["id"]), "apps", "id")
    middle = apps.agg(F.floor(F.max("id") / 3)).first()[0]
    summaries = Summaries(IngestStore(f"{base}/out"))
    for part in (F.col("offset") <= middle, F.col("offset") > middle):
        write_topic(messages.filter(part), f"{base}/topic")
        run_ingest(
            stream_topic(spark, f"{base}/topic"),
            summaries.store.base,
            f"{base}/checkpoint",
            batch_size=PART_BATCH,
            arity=len(names),
            positions={name: i for i, name in enumerate(names)},
        )
        summaries.refresh(spark)
    return summaries


def refreshed_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Itemsets of all snapshots, added up from the summaries of two refreshes."""
    found = _refreshed_apps(spark, sf_dir).itemsets(spark)
    return found.select("snapshot", F.get("items", F.lit(0)).alias("item"), "freq")


def refreshed_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill values, means and deviations of all snapshots, from the same summaries."""
    found = _refreshed_apps(spark, sf_dir).statistics(spark)
    return found.select(
        "snapshot", "feature", "row_count", "missing", *[rounded(F.col(c)).alias(c) for c in ("fill", "mean", "deviation")]
    )


def snapshot_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What training reports where no row belongs to the first snapshot: it is left out, the others are trained."""
    tier = F.when(F.length("App") <= 9, 2).otherwise(3)
    report = train_snapshots(
        app_rows(spark, sf_dir).withColumn("tier", tier), shared_dir(spark, "models"), kinds=["fpgrowth"]
    )
    trained = {path.rsplit(ITEMSET_PREFIX, 1)[1] for path in report.artifacts}
    rows = [(name, report.rows_read[name], report.rows_kept[name], name in trained) for name in SNAPSHOTS]
    return spark.createDataFrame(rows, "snapshot string, rows_read long, rows_kept long, trained boolean")


def too_few_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that fill two batches, and what training says of them."""
    base = shared_dir(spark, "two-batches")
    write_topic(_event_topic(spark, sf_dir), f"{base}/topic")
    topic = read_topic(spark, f"{base}/topic")
    accepted = judged_records(parse_messages(topic)).filter("reason IS NULL").count()
    store = ingest_topic(topic, f"{base}/out", batch_size=-(-accepted // 2))
    try:
        train_from_store(spark, store, f"{base}/models")
        said = None
    except ValueError as error:
        said = str(error)
    return store.read_batches(spark).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("batch_no").alias("batches"),
        F.lit(said).alias("said"),
    )


# --- mining -------------------------------------------------------------------


def single_item_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = _filled(spark, sf_dir)
    return mining.item_support(filled).select(F.get("items", F.lit(0)).alias("item"), "freq")


def single_item_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same itemsets from FP-growth over one-item transactions."""
    single = _filled(spark, sf_dir).select(F.array("Category").alias("items"))
    model = mining.fit_itemsets(mining.transactions(single))
    return mining.frequent_itemsets(model).select(
        F.get("items", F.lit(0)).alias("item"), "freq"
    )


def _baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    brands = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return mining.collect_baskets(
        lines.join(brands, "l_partkey"), "l_orderkey", "p_brand", BASKET_SUPPORT
    )


def basket_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = mining.mine_baskets(_baskets(spark, sf_dir), min_support=BASKET_SUPPORT)
    return found.select(
        F.array_join("items", ",").alias("items"), F.size("items").alias("set_size"), "freq"
    )


def association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, total = mining.mine_baskets(_baskets(spark, sf_dir), min_support=BASKET_SUPPORT)
    rules = mining.association_rules(found, total, BASKET_CONFIDENCE)
    return rules.select(
        F.array_join("antecedent", ",").alias("antecedent"),
        F.array_join("consequent", ",").alias("consequent"),
        rounded(F.col("confidence")).alias("confidence"),
        rounded(F.col("lift")).alias("lift"),
        rounded(F.col("support")).alias("support"),
    )


# --- features and models ------------------------------------------------------


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)


def feature_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    moments = features.feature_moments(_measures(spark, sf_dir), MEASURES)
    return moments.select(
        "feature",
        "row_count",
        rounded(F.col("mean")).alias("mean"),
        rounded(F.col("std")).alias("std"),
    )


def covariance_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = features.covariance_matrix(_measures(spark, sf_dir), MEASURES)
    return matrix.withColumn("covariance", rounded(F.col("covariance"), 4))


def _rounded_scales(df: DataFrame) -> DataFrame:
    return df.select(
        "l_orderkey",
        "l_linenumber",
        *[rounded(F.col(f"scaled_{c}")).alias(f"scaled_{c}") for c in MEASURES],
    )


def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _measures(spark, sf_dir)
    return _rounded_scales(
        features.scale_features(rows, features.fit_scaling(rows, MEASURES), MEASURES)
    )


def scaled_by_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_scales(features.scale_by_deviation(_measures(spark, sf_dir), MEASURES))


def nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measures(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", features.nearest_centre(MEASURES, CENTRES).alias("centre")
    )


def kmeans_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _measures(spark, sf_dir)
    model = models.fit_clusters(rows, MEASURES)
    return models.predict_clusters(rows, model)


def kmeans_assignment_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the fit, and how many are closer to another centre than to their own."""
    rows = _measures(spark, sf_dir)
    model = models.fit_clusters(rows, MEASURES)
    centres = [[float(v) for v in c] for c in model.stages[-1].clusterCenters()]
    scaled = features.scale_features(rows, features.fit_scaling(rows, MEASURES), MEASURES)
    names = [f"scaled_{c}" for c in MEASURES]
    predicted = models.predict_clusters(scaled, model)
    distances = F.array(*[features.squared_distance(names, c) for c in centres])
    own = F.get(distances, F.col("predicted_cluster_id"))
    return predicted.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(own > F.array_min(distances) + 1e-6).alias("misassigned"),
        (F.count_distinct("predicted_cluster_id") == len(centres)).alias("all_centres_used"),
    )


def kmeans_known_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten far groups of orders, whose sizes and centres the clusters must be."""
    group = F.col("o_custkey") % 10
    points = table(spark, sf_dir, "orders").select(
        (group * 1_000 + F.col("o_orderkey") % 7).cast("double").alias("x"),
        (group * group * 100 + F.col("o_orderkey") % 5).cast("double").alias("y"),
    )
    model = models.fit_clusters(points, ["x", "y"])
    return (
        models.predict_clusters(points, model)
        .groupBy("predicted_cluster_id")
        .agg(
            F.count(F.lit(1)).alias("size"),
            rounded(F.avg("x"), 4).alias("x"),
            rounded(F.avg("y"), 4).alias("y"),
        )
        .drop("predicted_cluster_id")
    )


def pca_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _measures(spark, sf_dir)
    return models.project(rows, models.fit_projection(rows, MEASURES))


def pca_rotation_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A projection on all components is a rotation, so every scaled row keeps its length."""
    rows = _measures(spark, sf_dir)
    model = models.fit_projection(rows, MEASURES, k=len(MEASURES))
    squares = F.transform("transformed_pca_features", lambda v: v * v)
    length = F.aggregate(squares, F.lit(0.0), lambda total, v: total + v)
    return models.project(rows, model).select(
        "l_orderkey", "l_linenumber", rounded(length, 4).alias("squared_length")
    )


def pca_component_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covariances of the components: none between them, falling along them, in sum those of the scaled rows."""
    rows = _measures(spark, sf_dir)
    names = [f"c{i}" for i in range(len(MEASURES))]

    def covariances(k: int) -> dict[tuple[str, str], float]:
        projected = models.project(rows, models.fit_projection(rows, MEASURES, k=k))
        parts = projected.select(*[F.get("transformed_pca_features", F.lit(i)).alias(names[i]) for i in range(k)])
        found = features.covariance_matrix(parts, names[:k]).collect()
        return {(r["feature_a"], r["feature_b"]): r["covariance"] for r in found}

    whole, part = covariances(len(MEASURES)), covariances(len(MEASURES) - 1)
    along = [whole[c, c] for c in names]
    between = max(abs(v) for m in (whole, part) for (a, b), v in m.items() if a != b)
    return spark.range(1).select(
        F.lit(round(sum(along), 6)).alias("total"),
        F.lit(round(sum(v * v for v in along), 6)).alias("squares"),
        F.lit(round(between, 6)).alias("between"),
        F.lit(along == sorted(along, reverse=True)).alias("falling"),
        F.lit(all(abs(part[c, c] - whole[c, c]) < 1e-9 for c in names[:-1])).alias("same_first"),
    )


# --- artifacts and scoring ----------------------------------------------------


def _scorer(spark: SparkSession, sf_dir: str, kind: str) -> Scorer:
    """Train and save one kind of artifact for the three snapshots of the app rows; load them."""
    path = shared_dir(spark, "models")
    train_snapshots(_tiered_apps(spark, sf_dir), path, kinds=[kind])
    return Scorer(spark, path)


def score_request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as score requests; price and status decide model and damage."""
    price = F.col("o_totalprice")
    orders = dealt(table(spark, sf_dir, "orders"), "o_orderkey")
    body = F.format_string(
        '{"Rating": %d, "Reviews": %d, "Size": %d.5, "Installs": %d, "Price": 0, "tag": "%s"}',
        (F.col("o_custkey") % 6),
        F.col("o_custkey"),
        F.col("o_custkey") % 50,
        F.col("o_custkey") % 90 * 1_000,
        F.col("o_orderpriority"),
    )
    damaged = (
        F.when(price < 2_000, "")
        .when(price < 4_000, "{}")
        .when(price < 8_000, F.replace(body, F.lit('"Price": 0, '), F.lit("")))
        .when(price < 12_000, F.replace(body, F.lit('"Price": 0'), F.lit('"Price": null')))
        .when(price < 16_000, F.replace(body, F.lit('"Price": 0'), F.lit('"Price": "free"')))
        .when(price < 20_000, F.concat(body, F.lit("}")))
        .otherwise(body)
    )
    model = (
        F.when(F.col("o_orderstatus") == "F", "model1")
        .when(F.col("o_orderstatus") == "O", "model3")
        .when(price < 300_000, "model2")
        .otherwise("model9")
    )
    return orders.select(
        F.col("o_orderkey").alias("request_id"), model.alias("model"), damaged.alias("body")
    )


def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer = _scorer(spark, sf_dir, "kmeans")
    return scorer.clusters(score_request_bodies(spark, sf_dir)).drop("input_features")


def score_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer = _scorer(spark, sf_dir, "pca")
    return scorer.projections(score_request_bodies(spark, sf_dir)).drop("input_features")


def score_request_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the JSON answers say, apart from the cluster ids themselves."""
    answers = _scorer(spark, sf_dir, "kmeans").clusters(score_request_bodies(spark, sf_dir))

    def said(path: str) -> Column:
        return F.get_json_object("response", path)

    return answers.select(
        "request_id",
        "code",
        said("$.model_used").alias("model_used"),
        said("$.input_features.Reviews").cast("bigint").alias("reviews"),
        said("$.input_features.tag").alias("tag"),
        said("$.predicted_cluster_id").cast("int").between(0, 9).alias("has_cluster"),
        said("$.error").isNotNull().alias("has_error"),
    )


def score_value_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Served clusters and projections beside those of the saved pipeline that each request names."""
    path = shared_dir(spark, "models")
    train_snapshots(_tiered_apps(spark, sf_dir), path, kinds=["kmeans", "pca"])
    scorer, bodies = Scorer(spark, path), score_request_bodies(spark, sf_dir)

    def compared(prefix: str, answers: DataFrame, apply, result: str, differs) -> DataFrame:
        parsed = scoring.parse_requests(bodies, prefix, [prefix + name for name in SNAPSHOTS])
        parsed = staged(parsed.filter("status = 'ok'").select("request_id", "artifact", *FEATURES), "parsed")
        parts = []
        for name in SNAPSHOTS:
            model = artifacts.load_models(spark, path, [prefix + name])[prefix + name]
            own = apply(parsed.filter(F.col("artifact") == prefix + name), model)
            parts.append(own.select("request_id", "artifact", F.col(result).alias("own")))
        own = parts[0].unionAll(parts[1]).unionAll(parts[2])
        served = answers.select("request_id", F.col(result).alias("served"))
        wrong = F.coalesce(differs(F.col("own"), F.col("served")), F.lit(True))
        return own.join(served, "request_id").groupBy("artifact").agg(
            F.count(F.lit(1)).alias("requests"), F.count_if(wrong).alias("wrong")
        )

    def far(a: Column, b: Column) -> Column:
        return F.exists(F.zip_with(a, b, lambda x, y: F.abs(x - y) > 1e-9), lambda d: d)

    return compared(
        CLUSTER_PREFIX, scorer.clusters(bodies), models.predict_clusters, "predicted_cluster_id", lambda a, b: a != b
    ).unionAll(
        compared(PROJECTION_PREFIX, scorer.projections(bodies), models.project, "transformed_pca_features", far)
    )


def score_request_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = ["kmeans_model1", "kmeans_model2", "kmeans_model3"]
    parsed = scoring.parse_requests(score_request_bodies(spark, sf_dir), "kmeans_", known)
    return parsed.select(
        "request_id",
        "status",
        scoring.status_code(F.col("status")).alias("code"),
        *[F.col(c).alias(c.lower()) for c in FEATURES],
    )


def score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests in two deliveries. Before the first, one model is saved; before the second it is replaced and another added.

    Counts by delivery, model and status, and how many answers differ from the
    pipeline that was saved under that name at the time.
    """
    base = shared_dir(spark, "serving")
    tiered = staged(cleaning.clean_features(_tiered_apps(spark, sf_dir)).select(*FEATURES, "Category", "tier"), "apps")
    complete = cleaning.drop_incomplete(cleaning.fill_missing(tiered)).select(*FEATURES, "tier")
    first = models.fit_clusters(snapshots.snapshot(complete, "model1").select(*FEATURES))
    whole = models.fit_clusters(complete.select(*FEATURES), k=4)
    saved = [{"model1": first}, {"model1": whole, "model3": whole}]
    requests = score_request_bodies(spark, sf_dir).withColumn("request_id", F.col("request_id").cast("string"))
    middle = table(spark, sf_dir, "orders").agg(F.floor(F.max("o_orderkey") / 2)).first()[0]
    parts = []
    for delivery, later in enumerate((False, True)):
        for name, model in saved[delivery].items():
            artifacts.save_model(model, f"{base}/models", CLUSTER_PREFIX + name)
        delivered = requests.filter((F.col("request_id").cast("long") > middle) == later)
        delivered.write.mode("append").json(f"{base}/requests")
        stream = spark.readStream.schema("request_id string, model string, body string").json(f"{base}/requests")
        start_scoring(stream, f"{base}/models", f"{base}/answers", f"{base}/checkpoint").awaitTermination()
        named = [CLUSTER_PREFIX + name for name in saved[delivery]]
        parsed = scoring.parse_requests(delivered, CLUSTER_PREFIX, named).select("request_id", "artifact", "status", *FEATURES)
        for name, model in saved[delivery].items():
            own = parsed.filter((F.col("artifact") == CLUSTER_PREFIX + name) & (F.col("status") == "ok"))
            predicted = models.predict_clusters(own, model)
            parts.append(predicted.select("request_id", F.col("predicted_cluster_id").alias("own")))
    expected = parts[0].unionAll(parts[1]).unionAll(parts[2])
    answers = spark.read.parquet(f"{base}/answers").join(expected, "request_id", "left")
    wrong = ~F.col("predicted_cluster_id").eqNullSafe(F.col("own"))
    return answers.groupBy((F.col("micro") + 1).cast("long").alias("delivery"), "model", "status").agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(wrong).alias("wrong")
    )


def itemset_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Itemsets saved, loaded and answered as JSON, shown as the fields of that JSON."""
    path = shared_dir(spark, "itemsets")
    artifacts.save_itemsets(
        mining.item_support(_filled(spark, sf_dir)), path, f"{ITEMSET_PREFIX}model3"
    )
    lines = Scorer(spark, path).itemset_response("model3")
    answer = F.from_json("response", "results_used string, items array<string>, freq bigint")
    return lines.select(answer.alias("r")).select(
        "r.results_used", F.array_join("r.items", ",").alias("items"), "r.freq"
    )


def trained_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The itemsets that training saved for each snapshot."""
    scorer = _scorer(spark, sf_dir, "fpgrowth")
    parts = [
        scorer.itemsets(name).select(
            F.lit(name).alias("snapshot"), F.get("items", F.lit(0)).alias("item"), "freq"
        )
        for name in ("model1", "model2", "model3")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def artifact_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifact names made from nations, and the customers whose nation has a cluster model."""
    names = table(spark, sf_dir, "nation").select(
        F.concat(
            F.when(F.col("n_regionkey") <= 1, "kmeans_")
            .when(F.col("n_regionkey") == 2, "pca_")
            .when(F.col("n_regionkey") == 3, "fpgrowth_results_")
            .otherwise("notes_"),
            F.col("n_nationkey").cast("string"),
        ).alias("name")
    )
    requests = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("model")
    )
    found = scoring.split_by_catalogue(requests, artifacts.describe_artifacts(names), "kmeans")
    return found.select("c_custkey", "model", "artifact", "known")


# --- stream -------------------------------------------------------------------


def _event_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages of three topic partitions, which arrive when the events happened."""
    messages = event_messages(spark, sf_dir).withColumn("partition", F.col("offset") % 3)
    return as_messages(messages, "apps", "offset", "partition", "ts")


def _deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    topic = _event_topic(spark, sf_dir)
    middle = table(spark, sf_dir, "events").agg(F.floor(F.max("event_id") / 2)).first()[0]
    return [topic.filter(F.col("offset") <= middle), topic.filter(F.col("offset") > middle)]


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in two deliveries, ingested by two runs that share checkpoint and ledger."""
    base = shared_dir(spark, "stream")
    for delivery in _deliveries(spark, sf_dir):
        write_topic(delivery, f"{base}/topic")
        stream = stream_topic(spark, f"{base}/topic")
        store = run_ingest(stream, f"{base}/out", f"{base}/checkpoint", batch_size=EVENT_BATCH)
    return store.read_batches(spark).select(
        F.col("offset").alias("event_id"), "row_no", "batch_no", "is_remainder", *BATCH_COLUMNS
    )


def compacted_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries by one stream; the store is compacted after each, and the second run goes on from the first."""
    base = shared_dir(spark, "compacted")
    for delivery in _deliveries(spark, sf_dir):
        write_topic(delivery, f"{base}/topic")
        stream = stream_topic(spark, f"{base}/topic")
        store = run_ingest(stream, f"{base}/out", f"{base}/checkpoint", batch_size=EVENT_BATCH)
        compact_in_place(spark, store, vacuum=True)
    return store.read_batches(spark).select(
        F.col("offset").alias("event_id"), "row_no", "batch_no", "is_remainder", *BATCH_COLUMNS
    )


def late_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of all times in two deliveries: numbers follow the deliveries, and late rows tell by how much."""
    base = shared_dir(spark, "late")
    events = table(spark, sf_dir, "events").select("event_id", F.col("event_type").isin("click", "error").alias("_first"))
    topic = _event_topic(spark, sf_dir).join(events, F.col("offset") == F.col("event_id")).drop("event_id")
    for first in (True, False):
        write_topic(topic.filter(F.col("_first") == first).drop("_first"), f"{base}/topic")
        stream = stream_topic(spark, f"{base}/topic")
        store = run_ingest(stream, f"{base}/out", f"{base}/checkpoint", batch_size=EVENT_BATCH)
    return store.read_arrivals(spark).select(
        F.col("offset").alias("event_id"), "row_no", "batch_no", F.round("lateness", 3).alias("lateness")
    )


class _NoLedger(IngestStore):
    """A store whose writer dies after the rows and before the ledger entry."""

    def write_ledger(self, spark: SparkSession, *entry: int) -> None:
        return


def ingest_after_crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second delivery is lost half-way and taken in again; ``committed`` tells what could be read between."""
    base = shared_dir(spark, "crash")
    first, second = _deliveries(spark, sf_dir)
    store = ingest_topic(first, f"{base}/out", batch_size=EVENT_BATCH)
    ingest_micro_batch(second, 1, _NoLedger(store.base), EVENT_BATCH)
    between = staged(store.read_batches(spark).select("row_no", F.lit(True).alias("seen")), "between")
    ingest_micro_batch(second, 1, store, EVENT_BATCH)
    rows = store.read_batches(spark).join(between, "row_no", "left")
    return rows.select(
        F.col("offset").alias("event_id"),
        "row_no",
        "batch_no",
        "is_remainder",
        F.col("seen").isNotNull().alias("committed"),
    )


def _whole_topic(spark: SparkSession, sf_dir: str) -> IngestStore:
    base = shared_dir(spark, "topic")
    write_topic(_event_topic(spark, sf_dir), f"{base}/topic")
    return ingest_topic(read_topic(spark, f"{base}/topic"), f"{base}/out", batch_size=EVENT_BATCH)


def topic_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole topic in one go: the same batches as by the stream."""
    rows = _whole_topic(spark, sf_dir).read_batches(spark)
    return rows.select(F.col("offset").alias("event_id"), "batch_no", *BATCH_COLUMNS)


def first_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two batches of the store, by a read that prunes the others."""
    rows = batches.up_to_batch(_whole_topic(spark, sf_dir).read_batches(spark), 2)
    return rows.select(F.col("offset").alias("event_id"), "batch_no")


def frequent_event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From messages to itemsets: which categories of accepted records reach the support."""
    accepted = accepted_records(judged_records(parse_messages(event_messages(spark, sf_dir))))
    filled = accepted.withColumn("Category", F.coalesce("Category", F.lit("Unknown")))
    return mining.item_support(filled).select(F.get("items", F.lit(0)).alias("item"), "freq")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        frequent_event_types,
        wire_roundtrip,
        wire_text_roundtrip,
        raw_csv_records,
        raw_csv_rows,
        dataset_ingest,
        arity_rejects,
        reject_reasons,
        project_by_position,
        count_window_batches,
        remainder_batch,
        batch_file_order,
        batch_csv_roundtrip,
        export_repair,
        cumulative_snapshots,
        clean_features,
        mean_fill,
        category_fill,
        drop_incomplete,
        propagated_nan,
        row_quality_profile,
        snapshot_mean_fill,
        single_item_support,
        single_item_growth,
        basket_itemsets,
        association_rules,
        feature_moments,
        covariance_matrix,
        scaled_features,
        scaled_by_deviation,
        nearest_centroid,
        kmeans_clusters,
        kmeans_assignment_check,
        kmeans_known_clusters,
        pca_projection,
        pca_rotation_check,
        pca_component_check,
        score_requests,
        score_projections,
        score_request_answers,
        score_value_check,
        score_request_status,
        itemset_json,
        trained_itemsets,
        artifact_catalog,
        stream_ingest,
        compacted_ingest,
        topic_ingest,
        first_batches,
        ingest_after_crash,
        late_arrivals,
        refreshed_itemsets,
        refreshed_statistics,
        snapshot_report,
        too_few_batches,
        score_stream,
    )
}
