"""Command line: run the streaming job, add old files, or fold the ledger.

    python -m topup_analytics stream --files LOGS --out OUT --checkpoint DIR
    python -m topup_analytics stream --kafka SERVERS --topic T --out OUT --checkpoint DIR
    python -m topup_analytics backfill --files LOGS --name NAME --out OUT
    python -m topup_analytics fold --out OUT [--seal NAME]
"""

import argparse

from pyspark.sql import DataFrame, SparkSession

from topup_analytics.sinks import jdbc_writer
from topup_analytics.sources import (
    batch_lines,
    kafka_lines,
    kafka_options,
    province_file,
    stream_lines,
)
from topup_analytics.streaming import StoredTables, TopupJob


def _parser() -> argparse.ArgumentParser:
    job = argparse.ArgumentParser(add_help=False)
    job.add_argument("--out", required=True, help="folder of the stored tables")
    job.add_argument("--mode", choices=["quarantine", "strict"], default="quarantine")
    job.add_argument("--missing-end", choices=["null", "epoch"], default="null")
    job.add_argument("--provinces", help="file of `code name` lines instead of the built-in ones")
    job.add_argument("--jdbc-url", help="append both tables there, not as Parquet")
    job.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")

    parser = argparse.ArgumentParser(prog="topup_analytics")
    commands = parser.add_subparsers(dest="command", required=True)
    stream = commands.add_parser("stream", parents=[job], help="keep all outputs up to date")
    source = stream.add_mutually_exclusive_group(required=True)
    source.add_argument("--files", help="folder of log files")
    source.add_argument("--kafka", help="bootstrap servers")
    stream.add_argument("--topic")
    stream.add_argument("--partitions", type=int, help="of the topic; turns the rate limit on")
    stream.add_argument("--records-per-second", type=int, default=100, help="per partition")
    stream.add_argument("--files-per-trigger", type=int)
    stream.add_argument("--bytes-per-trigger", type=int, help="of log files; not with --files-per-trigger")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--seconds", type=int, default=5, help="between batches")
    stream.add_argument("--available-now", action="store_true", help="stop when all is read")
    backfill = commands.add_parser("backfill", parents=[job], help="add old log files once")
    backfill.add_argument("--files", required=True)
    backfill.add_argument("--name", required=True, help="the same name replaces what it added")
    fold = commands.add_parser("fold", help="sum the older batches of all stored tables")
    fold.add_argument("--out", required=True)
    fold.add_argument("--seal", action="append", default=[], metavar="NAME", help="a backfill that is over")
    return parser


def _lines(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.files:
        return stream_lines(spark, args.files, args.files_per_trigger, args.bytes_per_trigger)
    options = kafka_options(
        args.kafka, args.topic, args.partitions, args.records_per_second, args.seconds
    )
    return kafka_lines(spark, options)


def main(arguments: list[str] | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(arguments)
    if args.command == "stream" and args.kafka and not args.topic:
        parser.error("--kafka needs --topic")
    spark = SparkSession.builder.getOrCreate()
    tables = StoredTables(args.out)
    if args.command == "fold":
        tables.fold(spark, args.seal)
        return
    write_table = None
    if args.jdbc_url:
        properties = dict(option.split("=", 1) for option in args.jdbc_option)
        write_table = jdbc_writer(args.jdbc_url, properties)
    provinces = province_file(spark, args.provinces) if args.provinces else None
    job = TopupJob(tables, args.mode, args.missing_end, write_table, provinces)
    if args.command == "backfill":
        job.backfill(batch_lines(spark, args.files), args.name)
        return
    trigger = {"processingTime": f"{args.seconds} seconds"}
    if args.available_now:
        trigger = {"availableNow": True}
    job.start(_lines(spark, args), args.checkpoint, trigger).awaitTermination()


if __name__ == "__main__":
    main()
