"""Command line: ``python -m gustline publish|ingest|tap|analyse|train|show``.

Every path, format, zone and limit is an argument; nothing is taken from the environment.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from gustline.plans.flows import analyse, train_from_table
from gustline.session import build_session
from gustline.sources.streams import (
    Endpoint,
    console,
    csv_landing,
    kafka_sink,
    kafka_source,
    table_sink,
    text_topic,
)
from gustline.sources.tables import check_apart, preview, read_table, replace_table, schema_report
from gustline.streaming.flows import distribute, ingest, publish, tap
from gustline.streaming.runs import batch_counts, run_bounded, total_rows


def _pairs(options: list[str]) -> dict[str, str]:
    return dict(option.split("=", 1) for option in options)


def _topic(args: argparse.Namespace, reading: bool) -> Endpoint:
    options = _pairs(args.topic_option)
    if args.servers is None:
        return text_topic(args.topic, **options)
    if reading:
        return kafka_source(args.servers, args.topic, args.starting, **options)
    return kafka_sink(args.servers, args.topic, **options)


def _told(query: StreamingQuery) -> None:
    print(batch_counts(query), "total", total_rows(query))


def _publish(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = csv_landing(args.landing, args.archive, args.age, **_pairs(args.source_option))
    _told(run_bounded(publish(spark, rows, _topic(args, False), args.checkpoint, args.age), args.timeout, args.every))


def _ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    table = table_sink(args.table, args.format)
    if args.copy or args.quarantine:
        copy = text_topic(args.copy) if args.copy else None
        damaged = table_sink(args.quarantine, args.format) if args.quarantine else None
        writer = distribute(spark, _topic(args, True), args.checkpoint, table, copy, damaged, args.partition_by)
        _told(run_bounded(writer, args.timeout, args.every))
        return
    writer = ingest(
        spark,
        _topic(args, True),
        table,
        args.checkpoint,
        args.partition_by,
        _pairs(args.promote),
        args.tasks_per_day,
    )
    _told(run_bounded(writer, args.timeout, args.every))


def _tap(spark: SparkSession, args: argparse.Namespace) -> None:
    run_bounded(tap(spark, _topic(args, True), console(args.rows), args.checkpoint), args.timeout, args.every)


def _analyse(spark: SparkSession, args: argparse.Namespace) -> None:
    analyse(spark, args.table, args.hourly, args.daily, args.format, args.only_valid)


def _train(spark: SparkSession, args: argparse.Namespace) -> None:
    check_apart(args.hourly, args.out)
    result = train_from_table(spark, args.hourly, args.day, args.format, args.handle_invalid, args.exact_split)
    print("left out", result.left_out)
    replace_table(result.metrics, f"{args.out}/metrics", args.format)
    replace_table(result.day, f"{args.out}/day", args.format)
    for name, model in result.models.items():
        model.write().overwrite().save(f"{args.out}/models/{name}")
        replace_table(result.histogram(name), f"{args.out}/histogram/{name}", args.format)
        replace_table(result.density(name), f"{args.out}/density/{name}", args.format)
        replace_table(result.joint_counts(name), f"{args.out}/joint_counts/{name}", args.format)


def _show(spark: SparkSession, args: argparse.Namespace) -> None:
    table = read_table(spark, args.table, args.format)
    schema_report(table).show(truncate=False)
    preview(table, args.rows).show(args.rows, truncate=False)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="gustline")
    parser.add_argument("--time-zone", required=True)
    parser.add_argument("--master")
    parser.add_argument("--format", default="parquet")
    commands = parser.add_subparsers(required=True)

    def command(name: str, run) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.set_defaults(run=run)
        return sub

    def streaming(sub: argparse.ArgumentParser, resumes: bool = True) -> None:
        sub.add_argument("--topic", required=True, help="topic name, or directory without --servers")
        sub.add_argument("--servers", help="Kafka bootstrap servers")
        sub.add_argument("--topic-option", action="append", default=[])
        sub.add_argument("--checkpoint", required=resumes)
        sub.add_argument("--timeout", type=int, help="seconds")
        sub.add_argument("--every", help="trigger interval, such as '10 seconds'; runs until --timeout")

    sub = command("publish", _publish)
    sub.add_argument("--landing", required=True)
    sub.add_argument("--source-option", action="append", default=[])
    sub.add_argument("--archive", help="folder that read files are moved to")
    sub.add_argument("--age", default="7 days", help="with --archive, how long the driver remembers files")
    streaming(sub)

    sub = command("ingest", _ingest)
    streaming(sub)
    sub.add_argument("--starting", default="earliest")
    sub.add_argument("--table", required=True)
    sub.add_argument("--partition-by", action="append", default=[])
    sub.add_argument("--promote", action="append", default=[], help="column=signal key")
    sub.add_argument("--tasks-per-day", type=int)
    sub.add_argument("--copy", help="folder for copies of all message bodies, from the same reading")
    sub.add_argument("--quarantine", help="table for damaged messages with body and reason, from the same reading")

    sub = command("tap", _tap)
    streaming(sub, resumes=False)
    sub.add_argument("--starting", default="earliest")
    sub.add_argument("--rows", type=int, default=20)

    sub = command("analyse", _analyse)
    for name in ("table", "hourly", "daily"):
        sub.add_argument(f"--{name}", required=True)
    sub.add_argument("--only-valid", action="store_true", help="leave out readings without a time")

    sub = command("train", _train)
    sub.add_argument("--handle-invalid", choices=["error", "skip"], default="error")
    sub.add_argument("--exact-split", action="store_true", help="test rows of exactly the wanted number")
    sub.add_argument("--hourly", required=True)
    sub.add_argument("--day", required=True, type=dt.date.fromisoformat)
    sub.add_argument("--out", required=True)

    sub = command("show", _show)
    sub.add_argument("--table", required=True)
    sub.add_argument("--rows", type=int, default=20)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session("gustline", args.time_zone, master=args.master)
    try:
        args.run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
