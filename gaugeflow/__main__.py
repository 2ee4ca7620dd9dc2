"""The programs: ``python -m gaugeflow <command>`` or through spark-submit.

Topics live below ``--topics``; with ``--brokers`` they are Kafka topics. A
stream runs until it is stopped, or to the topic's current end with
``--bounded``.
"""

import argparse

from pyspark.sql import DataFrame, SparkSession

from gaugeflow.operators import WideTable, show
from gaugeflow.operators.wide_table import FAMILIES
from gaugeflow.plans.jobs import publish_files, write_daily_stats
from gaugeflow.schemas import TOPIC
from gaugeflow.session import get_session, sized_shuffle
from gaugeflow.sources.kafka import publish_kafka, read_kafka
from gaugeflow.sources.lines import read_lines, stream_lines
from gaugeflow.sources.topic import read_topic, topic_names
from gaugeflow.streaming import (
    REPORT,
    drain,
    drain_counts,
    drain_total,
    sql_report,
    stream_reports,
    stream_to_table,
    stream_to_topic,
)


# What a batch takes at most unless --per-batch says otherwise. The rest waits for
# the next batches; nothing is skipped.
FILES_PER_BATCH = 100
RECORDS_PER_BATCH = 10_000_000


def _records(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.brokers:
        records = args.per_batch or RECORDS_PER_BATCH
        return read_kafka(spark, args.brokers, args.topic, True, records_per_batch=records)
    files = args.per_batch or FILES_PER_BATCH
    return read_topic(spark, args.topics, args.topic, True, files_per_batch=files)


def _table(spark: SparkSession, args: argparse.Namespace) -> WideTable:
    return WideTable(spark, args.table, args.by_arrival)


def _publish(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.checkpoint:
        if args.brokers:
            raise SystemExit("--checkpoint follows files into file topics only")
        lines = stream_lines(spark, args.lines, FILES_PER_BATCH)
        stream_to_topic(lines, args.topics, args.topic, args.checkpoint, args.bounded).awaitTermination()
    elif args.brokers:
        publish_kafka(read_lines(spark, args.lines), args.brokers, args.topic)
    else:
        publish_files(spark, args.lines, args.topics, args.topic)


def _drain(spark: SparkSession, args: argparse.Namespace) -> None:
    drain(_records(spark, args), args.out, args.run, args.checkpoint, args.polls, args.seconds)
    show("messages read", drain_counts(spark, args.out, args.run).orderBy("batch"))
    show("total messages received", drain_total(spark, args.out, args.run))


def _report(spark: SparkSession, args: argparse.Namespace) -> None:
    named = dict(text.split("=", 1) for text in args.sql)
    reports = {name: sql_report(text) for name, text in named.items()} or REPORT
    stream_reports(
        _records(spark, args),
        args.out,
        args.run,
        args.checkpoint,
        reports,
        args.bounded,
        echo=not args.quiet,
    ).awaitTermination()


def _ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    if len(topic_names(args.topic)) > 1 and not args.by_arrival:
        raise SystemExit("offsets of several topics have no order: use --by-arrival")
    table = _table(spark, args)
    table.create()
    stream_to_table(
        _records(spark, args),
        table,
        args.run,
        args.checkpoint,
        args.bounded,
        echo=not args.quiet,
    ).awaitTermination()


def _stats(spark: SparkSession, args: argparse.Namespace) -> None:
    table = _table(spark, args)
    write_daily_stats(table, echo=not args.quiet, changed=args.changed)


def _scan(spark: SparkSession, args: argparse.Namespace) -> None:
    table = _table(spark, args)
    with sized_shuffle(spark, table.root):
        rows = (
            table.scan_family(args.family, args.limit)
            if args.family
            else table.scan_wide(args.limit)
        )
        rows.show(args.limit, truncate=False)


def _compact(spark: SparkSession, args: argparse.Namespace) -> None:
    table = _table(spark, args)
    families = [args.family] if args.family else list(FAMILIES)
    for family in families:
        table.compact(family, args.idle)


def _truncate(spark: SparkSession, args: argparse.Namespace) -> None:
    _table(spark, args).truncate()


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="gaugeflow", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name, function, help):
        added = commands.add_parser(name, help=help)
        added.set_defaults(function=function)
        return added

    def topic_options(added):
        added.add_argument("topic", nargs="?", default=TOPIC)
        place = added.add_mutually_exclusive_group(required=True)
        place.add_argument("--topics", help="folder of file topics")
        place.add_argument("--brokers", help="Kafka bootstrap servers")

    def stream_options(added):
        topic_options(added)
        added.add_argument("--run", required=True, help="name of this checkpoint")
        added.add_argument("--checkpoint", required=True)
        added.add_argument("--per-batch", type=int, help=f"files ({FILES_PER_BATCH}) or Kafka records ({RECORDS_PER_BATCH}) per batch")

    def long_running(added):
        added.add_argument("--bounded", action="store_true")
        added.add_argument("--quiet", action="store_true", help="print no previews")

    def table_options(added):
        added.add_argument("--table", required=True)
        added.add_argument("--by-arrival", action="store_true")

    added = command("publish", _publish, "send the lines of text files to a topic")
    topic_options(added)
    added.add_argument("--lines", required=True, help="file or folder of lines")
    added.add_argument("--checkpoint", help="go on with files that arrive, from what it has")
    added.add_argument("--bounded", action="store_true", help="with --checkpoint: stop at the files there now")

    added = command("drain", _drain, "read a topic to its end and count messages")
    stream_options(added)
    added.add_argument("--out", required=True)
    added.add_argument("--polls", type=int, help="batches to take at most")
    added.add_argument("--seconds", type=float, help="time after which no batch begins")

    added = command("report", _report, "report on every micro-batch")
    stream_options(added)
    long_running(added)
    added.add_argument("--out", required=True)
    added.add_argument(
        "--sql", action="append", default=[], metavar="NAME=TEXT",
        help="SQL over the batch's sensor relation instead of the built-in report",
    )

    added = command("ingest", _ingest, "keep a wide table up to date from a topic")
    stream_options(added)
    long_running(added)
    table_options(added)

    added = command("stats", _stats, "write daily statistics into the table")
    table_options(added)
    added.add_argument("--changed", action="store_true", help="only of days that changed since the last run")
    added.add_argument("--quiet", action="store_true", help="print no previews")

    added = command("scan", _scan, "print the first rows of the table in key order")
    table_options(added)
    added.add_argument("--family", choices=FAMILIES)
    added.add_argument("--limit", type=int, default=50)

    added = command("compact", _compact, "merge small batches of the table")
    table_options(added)
    added.add_argument(
        "--idle", action="store_true", help="no stream runs: merge the newest too"
    )
    added.add_argument("--family", choices=FAMILIES)

    added = command("truncate", _truncate, "empty the table")
    table_options(added)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    args.function(get_session(f"gaugeflow {args.command}"), args)


if __name__ == "__main__":
    main()
