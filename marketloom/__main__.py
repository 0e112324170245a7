"""Jobs for spark-submit: publish, ingest, export, compact, train, refresh, register, score, serve, itemsets."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from marketloom.plans.ingest import publish_dataset
from marketloom.plans.refresh import refresh_itemsets
from marketloom.plans.serving import Scorer, start_scoring
from marketloom.plans.training import train_from_files, train_from_store
from marketloom.schema import BATCH_SIZE, PER_TRIGGER
from marketloom.session import staging
from marketloom.sources.artifacts import register_artifacts
from marketloom.sources.topic import stream_topic
from marketloom.streaming.ingest import (
    IngestStore,
    compact_in_place,
    compact_store,
    export_batch_files,
    start_ingest,
)


def _topic_options(args: argparse.Namespace) -> dict:
    if args.bootstrap:
        return {"kafka": {"kafka.bootstrap.servers": args.bootstrap}}
    return {}


def _publish(spark: SparkSession, args: argparse.Namespace) -> None:
    publish_dataset(
        spark,
        args.dataset,
        args.topic,
        topic_path=args.topic_path,
        multiline=not args.lines,
        partitions=args.partitions,
        **_topic_options(args),
    )


def _ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    options = _topic_options(args)
    if options:
        options["kafka"]["subscribe"] = args.topic
    stream = stream_topic(
        spark,
        args.topic_path,
        per_trigger=args.per_trigger,
        min_partitions=args.min_partitions,
        **options,
    )
    start_ingest(
        stream, args.store, args.checkpoint, batch_size=args.batch_size, every=args.every
    ).awaitTermination()


def _export(spark: SparkSession, args: argparse.Namespace) -> None:
    export_batch_files(spark, IngestStore(args.store), args.batches, args.final)


def _compact(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.output:
        compact_store(spark, IngestStore(args.store), args.output)
    else:
        compact_in_place(spark, IngestStore(args.store), args.vacuum)


def _train(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.store:
        report = train_from_store(spark, IngestStore(args.store), args.models, nan=args.nan)
    else:
        report = train_from_files(spark, args.batches, args.models, args.order, nan=args.nan)
    print(report)


REQUEST = "request_id string, model string, body string"


def _serve(spark: SparkSession, args: argparse.Namespace) -> None:
    requests = spark.readStream.schema(REQUEST).json(args.requests)
    start_scoring(requests, args.models, args.output, args.checkpoint, args.kind, args.every).awaitTermination()


def _register(spark: SparkSession, args: argparse.Namespace) -> None:
    print(register_artifacts(spark, args.models))


def _refresh(spark: SparkSession, args: argparse.Namespace) -> None:
    print(refresh_itemsets(spark, IngestStore(args.store), args.models))


def _score(spark: SparkSession, args: argparse.Namespace) -> None:
    scorer = Scorer(spark, args.models)
    requests = spark.read.json(args.requests, schema=REQUEST)
    answer = scorer.clusters if args.kind == "clusters" else scorer.projections
    answer(requests).drop("input_features").write.mode("overwrite").parquet(args.output)


def _itemsets(spark: SparkSession, args: argparse.Namespace) -> None:
    lines = Scorer(spark, args.models).itemset_response(args.model)
    lines.select("response").write.mode("overwrite").text(args.output)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="marketloom", description=__doc__)
    jobs = parser.add_subparsers(required=True)

    def job(name, run, *required):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    for sub in (
        job("publish", _publish, "dataset"),
        job("ingest", _ingest, "store", "checkpoint"),
    ):
        sub.add_argument("--topic", default="app_records")
        where = sub.add_mutually_exclusive_group(required=True)
        where.add_argument("--topic-path", help="directory that stands for a topic")
        where.add_argument("--bootstrap", help="Kafka brokers; needs the Kafka connector")
        if sub.prog.endswith("publish"):
            sub.add_argument("--lines", action="store_true", help="no line breaks inside fields; splits large files")
            sub.add_argument("--partitions", type=int, default=1, help="partitions of the Kafka topic")
        else:
            sub.add_argument("--batch-size", type=int, default=BATCH_SIZE)
            sub.add_argument(
                "--per-trigger", type=int, default=PER_TRIGGER, help="offsets (Kafka) or files per micro-batch"
            )
            sub.add_argument("--min-partitions", type=int, help="read tasks for a Kafka topic")
            sub.add_argument("--every", help="interval; without it, take what there is and stop")

    export = job("export", _export, "store", "batches")
    export.add_argument("--final", action="store_true", help="write the partial last batch too")

    compact = job("compact", _compact, "store")
    where = compact.add_mutually_exclusive_group()
    where.add_argument("--output", help="a store of its own; without it, the store is compacted in place")
    where.add_argument("--vacuum", action="store_true", help="remove what the compaction stands for")

    train = job("train", _train, "models")
    source = train.add_mutually_exclusive_group(required=True)
    source.add_argument("--batches", help="directory of CSV batch files")
    source.add_argument("--store", help="output of the ingest job")
    train.add_argument("--order", choices=["numeric", "lexical"], default="numeric")
    train.add_argument("--nan", choices=["missing", "propagate"], default="missing")

    job("refresh", _refresh, "store", "models")
    job("register", _register, "models")

    serve = job("serve", _serve, "models", "requests", "output", "checkpoint")
    serve.add_argument("--every", help="interval; without it, answer what there is and stop")
    for sub in (serve, job("score", _score, "models", "requests", "output")):
        sub.add_argument("--kind", choices=["clusters", "projections"], default="clusters")

    job("itemsets", _itemsets, "models", "model", "output")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("marketloom").getOrCreate()
    with staging(spark):
        args.run(spark, args)


if __name__ == "__main__":
    main()
