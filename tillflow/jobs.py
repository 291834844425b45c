"""Command line of the jobs; see ``run.py``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tillflow.operators import serving
from tillflow.operators.totals import COLLECTIONS
from tillflow.plans import history, pipelines
from tillflow.plans.publish import kafka_options
from tillflow.session import build_session
from tillflow.sources import stored, topics
from tillflow.streaming import sinks
from tillflow.streaming.run import AVAILABLE_NOW, EVERY_5_SECONDS, await_any, drain

STREAMS = ("main", "separate", "keyed", "raw", "publish", "offsets")


def _pairs(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="run.py")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in STREAMS:
        job = jobs.add_parser(name)
        job.add_argument("--root", required=True, help="folder of the outputs and checkpoints")
        job.add_argument("--checkpoints", help="folder of the checkpoints, if not below the root")
        source = job.add_mutually_exclusive_group(required=True)
        source.add_argument("--servers", help="Kafka brokers")
        source.add_argument("--topic-files", help="folder of Parquet files of topic rows")
        source.add_argument("--text-files", help="folder of files with one JSON message per line")
        # Fixed value: the topic's name.
        job.add_argument("--topic", default="commerce")
        job.add_argument("--source-option", action="append", default=[], metavar="KEY=VALUE")
        job.add_argument("--starting-offsets", default="latest")
        job.add_argument("--ignore-data-loss", action="store_true")
        job.add_argument("--max-offsets-per-trigger", type=int)
        job.add_argument("--min-partitions", type=int)
        job.add_argument("--drop-doubles-within", metavar="TIME", help="drop messages delivered again, as '1 hour'")
        job.add_argument("--once", action="store_true", help="process what is there, then stop")
        if name in ("main", "separate", "keyed"):
            job.add_argument("--mode", choices=("draw", "passthrough"), default="draw")
            job.add_argument("--hot-format", help="connector of the keyed table")
            job.add_argument("--hot-option", action="append", default=[], metavar="KEY=VALUE")
            job.add_argument("--defaults", action="store_true", help="fill missing transaction details")
        for option, default in vars(sinks.Tuning()).items():
            job.add_argument(f"--{option.replace('_', '-')}", type=int, default=default)
        if name in ("main", "separate"):
            job.add_argument("--collections-format", help="connector of the aggregate collections")
            job.add_argument("--collections-option", action="append", default=[], metavar="KEY=VALUE",
                             help="'{collection}' in a value stands for the collection's name")
        if name == "main":
            job.add_argument("--console", action="store_true", help="also print year by country")
        if name == "publish":
            target = job.add_mutually_exclusive_group(required=True)
            target.add_argument("--to-topic", help="topic to publish to, on --to-servers")
            target.add_argument("--to-files", help="folder to publish to instead")
            job.add_argument("--to-servers", help="Kafka brokers to publish to, if not those of the source")

    serve = jobs.add_parser("serve", help="current totals of the collections as JSON records")
    serve.add_argument("--root", required=True)
    serve.add_argument("--out", required=True)
    serve.add_argument("--last-documents", type=int, metavar="N",
                       help="sum the N newest snapshots, as the dashboard does, in place of current totals")
    sql = jobs.add_parser("history", help="SQL over the archive, registered as view 'transactions'")
    sql.add_argument("--root", required=True)
    sql.add_argument("sql")
    answer = sql.add_mutually_exclusive_group(required=True)
    answer.add_argument("--out", help="folder for the whole answer, as JSON")
    answer.add_argument("--rows", type=int, metavar="N", help="print the first N rows instead, and whether there are more")
    gaps = jobs.add_parser("gaps", help="offsets that the job 'offsets' never saw, as JSON")
    gaps.add_argument("--root", required=True)
    gaps.add_argument("--out", required=True)
    compact = jobs.add_parser("compact", help="fold the finished epochs of a pipeline, running or stopped")
    compact.add_argument("--root", required=True)
    vacuum = jobs.add_parser("vacuum", help="delete what folding has replaced, once no reader needs it")
    vacuum.add_argument("--root", required=True)
    return parser


def _source(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    options = _pairs(args.source_option)
    if args.topic_files:
        return topics.topic_files(spark, args.topic_files, **options)
    if args.text_files:
        return topics.text_files(spark, args.text_files, args.topic, **options)
    return topics.kafka_topic(
        spark, args.servers, args.topic, args.starting_offsets, not args.ignore_data_loss,
        args.max_offsets_per_trigger, args.min_partitions, **options)


def _targets(args: argparse.Namespace) -> pipelines.Targets:
    hot = collections = None
    if args.hot_format:
        hot = sinks.connector(args.hot_format, **_pairs(args.hot_option))
    if getattr(args, "collections_format", None):
        options = _pairs(args.collections_option)

        def collections(name: str):
            named = {key: value.replace("{collection}", name) for key, value in options.items()}
            return sinks.connector(args.collections_format, epoch_column="batch_id", **named)
    return pipelines.Targets(hot, collections)


def _stream(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = _source(spark, args)
    if args.drop_doubles_within:
        raw = topics.once(raw, args.drop_doubles_within)
    layout = pipelines.Layout(args.root, args.checkpoints)
    trigger = AVAILABLE_NOW if args.once else EVERY_5_SECONDS
    tuning = sinks.Tuning(**{name: getattr(args, name) for name in vars(sinks.Tuning())})
    if args.job == "main":
        queries = pipelines.main_pipeline(raw, layout, _targets(args), trigger, args.mode,
                                          args.defaults, args.console, tuning)
    elif args.job == "separate":
        queries = pipelines.separate_pipeline(raw, layout, _targets(args), trigger, args.mode, args.defaults, tuning)
    elif args.job == "keyed":
        queries = pipelines.keyed_pipeline(raw, layout, _targets(args), trigger, args.mode,
                                           defaults=args.defaults, tuning=tuning)
    elif args.job == "raw":
        queries = pipelines.raw_pipeline(raw, layout, trigger=trigger, tuning=tuning)
    elif args.job == "offsets":
        queries = [pipelines.start_offsets(raw, layout, trigger)]
    elif args.to_files:
        queries = pipelines.publish_pipeline(raw, layout, "text", trigger, tuning, path=args.to_files)
    else:
        queries = pipelines.publish_pipeline(raw, layout, "kafka", trigger, tuning,
                                             **kafka_options(args.to_servers or args.servers, args.to_topic))
    drain(queries) if args.once else await_any(queries)


def _serve(spark: SparkSession, args: argparse.Namespace) -> None:
    layout = pipelines.Layout(args.root)
    stored.require_root(spark, layout.root)
    for name in COLLECTIONS:
        docs = stored.read_collection(spark, layout.collection(name), name)
        if args.last_documents:
            totals = serving.dashboard_rollup(docs, name, args.last_documents)
        else:
            totals = serving.latest_totals(docs, name)
        serving.as_records(totals).write.mode("overwrite").text(f"{args.out}/{name}")


def _history(spark: SparkSession, args: argparse.Namespace) -> None:
    layout = pipelines.Layout(args.root)
    stored.require_root(spark, layout.root)
    history.open_history(spark, layout.archive)
    answer = spark.sql(args.sql)
    if args.out:
        answer.write.mode("overwrite").json(args.out)
    else:
        sinks.console(args.rows)(answer, 0)


def main(argv: list[str] | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.job == "publish" and args.to_topic and not (args.to_servers or args.servers):
        parser.error("--to-topic needs --to-servers")
    spark = build_session(f"tillflow {args.job}")
    if args.job in STREAMS:
        _stream(spark, args)
    elif args.job == "serve":
        _serve(spark, args)
    elif args.job == "history":
        _history(spark, args)
    elif args.job == "gaps":
        layout = pipelines.Layout(args.root)
        stored.require_root(spark, layout.root)
        stored.read_gaps(spark, layout.offsets).write.mode("overwrite").json(args.out)
    elif args.job == "compact":
        history.compact(spark, pipelines.Layout(args.root))
    else:
        history.vacuum(spark, pipelines.Layout(args.root))
