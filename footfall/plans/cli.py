"""Command line of the batch programs, for spark-submit or ``python -m footfall.plans.cli``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from footfall.plans import runs
from footfall.plans.jobs import assign_users, read_input, segment_report, segment_users, transform_events
from footfall.session import build_session
from footfall.sources.events import event_lines, kafka_events, publish_messages, stream_events
from footfall.sources.tables import write_tables
from footfall.streaming import compaction, whole
from footfall.streaming.landing import land_events
from footfall.streaming.live import rejected_times, start_append, stream_features


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="footfall")
    commands = parser.add_subparsers(dest="command", required=True)

    transform = commands.add_parser("transform", help="events to one feature row per user")
    transform.add_argument("--input-path", required=True)
    transform.add_argument("--output-path", required=True)
    transform.add_argument("--start-date", required=True, help="first day, YYYY-MM-DD")
    transform.add_argument("--end-date", required=True, help="last day, included")
    transform.add_argument("--closed", choices=["day", "both"], default="day")
    transform.add_argument("--landed", action="store_true", help="input is a landed table")
    transform.add_argument("--temporal", action="store_true", help="add temporal columns")
    transform.add_argument("--events", choices=["parsed", "valid"], default="parsed",
                           help="all events that parse, or those that break no rule")
    transform.add_argument("--run-date")

    segment = commands.add_parser("segment", help="cluster users into segments")
    segment.add_argument("--features-path", required=True)
    segment.add_argument("--output-path", required=True)
    segment.add_argument("--num-clusters", type=int, default=5)
    segment.add_argument("--partitions", type=int,
                         help="draw the first centres by MLlib over so many partitions, which are part of the result")
    segment.add_argument("--model-path", help="folder for the fit, for assign")
    segment.add_argument("--keep-ids-of", help="an earlier fit whose segment ids go on")
    segment.add_argument("--report-path", help="folder for the tables that are printed")
    segment.add_argument("--scale", action="store_true")
    segment.add_argument("--run-date")

    assign = commands.add_parser("assign", help="segments of users by a stored fit")
    assign.add_argument("--features-path", required=True)
    assign.add_argument("--model-path", required=True)
    assign.add_argument("--output-path", required=True)
    assign.add_argument("--run-date")

    report = commands.add_parser("report", help="headline metrics and segment tables")
    report.add_argument("--features-path", required=True)
    report.add_argument("--segments-path", required=True)
    report.add_argument("--segments", type=int, nargs="*", help="segments to keep, default all")
    report.add_argument("--output-path", help="folder for all report tables")
    report.add_argument("--run-date")

    publish = commands.add_parser("publish", help="stored events to a Kafka topic")
    publish.add_argument("--input-path", required=True)
    publish.add_argument("--bootstrap-servers", required=True)
    publish.add_argument("--topic", required=True)

    land = commands.add_parser("land", help="land an event stream as a partitioned table")
    live = commands.add_parser(
        "live",
        help="daily features and sessions of an event stream",
        description="Without --whole, a run that stops at the end of its input does not emit days and sessions still open.",
    )
    for stream in (land, live):
        stream.add_argument("--output-path", required=True)
        stream.add_argument("--checkpoint", required=True)
        source = stream.add_mutually_exclusive_group(required=True)
        source.add_argument("--input-path", help="folder that receives JSON files")
        source.add_argument("--bootstrap-servers")
        stream.add_argument("--topic")
        stream.add_argument("--starting-offsets", default="earliest", help="where a new checkpoint begins")
        stream.add_argument("--max-offsets-per-trigger", type=int)
        stream.add_argument("--max-files-per-trigger", type=int)
        stream.add_argument("--interval", help="keep running, e.g. '1 minute'; default: stop at the end")
    land.add_argument("--files-per-day", type=int, help="shuffle to this many files per batch")
    live.add_argument("--watermark", default="1 hour", help="how late an event may be")
    live.add_argument("--gap-seconds", type=int, default=1800)
    live.add_argument("--whole", action="store_true",
                      help="keep results with days and sessions still open; read them with snapshot")
    snapshot = commands.add_parser("snapshot", help="daily features and sessions of live --whole, as they are now")
    snapshot.add_argument("--input-path", required=True, help="output path of live --whole")
    snapshot.add_argument("--output-path", required=True)
    snapshot.add_argument("--gap-seconds", type=int, default=1800)
    sessions = commands.add_parser("sessions", help="sessions of one day, going on from the run before")
    distincts = commands.add_parser("distincts", help="exact bitmaps of one day, to count over any range of days")
    for daily in (sessions, distincts):
        daily.add_argument("--input-path", required=True)
        daily.add_argument("--output-path", required=True)
        daily.add_argument("--run-date", required=True, help="YYYY-MM-DD")
        daily.add_argument("--landed", action="store_true", help="input is a landed table")
        daily.add_argument("--events", choices=["parsed", "valid"], default="parsed")
    sessions.add_argument("--gap-seconds", type=int, default=1800)
    compact = commands.add_parser("compact", help="copy closed days of a landed table to few files")
    compact.add_argument("--input-path", required=True, help="a landed table")
    compact.add_argument("--output-path", required=True, help="where the copies are kept")
    compact.add_argument("--through", required=True, help="last closed day, YYYY-MM-DD")
    days = commands.add_parser("days", help="landed events to one feature row per user and day")
    refresh = commands.add_parser("refresh", help="bring days up to date with events that landed since")
    for by_day in (days, refresh):
        by_day.add_argument("--input-path", required=True, help="a landed table")
        by_day.add_argument("--output-path", required=True, help="features by run_date")
        by_day.add_argument("--events", choices=["parsed", "valid"], default="parsed")
    days.add_argument("--start-date", required=True)
    days.add_argument("--end-date", required=True)
    args = parser.parse_args(argv)
    if args.command in ("land", "live") and args.bootstrap_servers and not args.topic:
        parser.error("--bootstrap-servers needs --topic")
    return args


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session(f"footfall {args.command}")
    if args.command == "transform":
        transform_events(
            spark, args.input_path, args.output_path, args.start_date, args.end_date,
            closed=args.closed, landed=args.landed, temporal=args.temporal, run_date=args.run_date,
            events=args.events,
        )
    elif args.command == "segment":
        result = segment_users(
            spark, args.features_path, args.output_path, args.num_clusters,
            partitions=args.partitions, scale=args.scale, run_date=args.run_date,
            report_path=args.report_path, model_path=args.model_path, keep_ids_of=args.keep_ids_of,
        )
        print(f"Silhouette: {result.silhouette}")
        show_whole(result.tables())
    elif args.command == "assign":
        sizes = assign_users(spark, args.features_path, args.model_path, args.output_path, args.run_date)
        show_whole({"sizes": sizes})
    elif args.command == "report":
        tables = segment_report(
            spark, args.features_path, args.segments_path, args.segments, args.run_date, args.output_path
        )
        show_whole(tables)
    elif args.command == "publish":
        publish_messages(event_lines(spark, args.input_path), args.bootstrap_servers, args.topic)
    elif args.command in ("sessions", "distincts"):
        events = read_input(spark, args.input_path, args.landed, args.events)
        if args.command == "sessions":
            runs.sessions_run(spark, events, args.output_path, args.run_date, args.gap_seconds)
        else:
            runs.distincts_run(spark, events, args.output_path, args.run_date)
    elif args.command == "compact":
        print("Copied:", *compaction.compact_days(spark, args.input_path, args.output_path, args.through))
    elif args.command == "days":
        runs.transform_days(spark, args.input_path, args.output_path, args.start_date, args.end_date, args.events)
    elif args.command == "refresh":
        print("Refreshed:", *runs.refresh_days(spark, args.input_path, args.output_path, args.events))
    elif args.command == "snapshot":
        write_tables(
            {
                "daily": whole.read_daily(spark, args.input_path),
                "sessions": whole.read_sessions(spark, args.input_path, args.gap_seconds),
            },
            args.output_path,
        )
    else:
        run_streams(spark, args)


def show_whole(tables: dict[str, DataFrame]) -> None:
    """Print every row of a few small tables."""
    for name, table in tables.items():
        print(name)
        table.show(n=max(1, table.count()), truncate=False)


def run_streams(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.input_path:
        limit = args.max_files_per_trigger
        events = stream_events(spark, args.input_path, **({"maxFilesPerTrigger": str(limit)} if limit else {}))
    else:
        events = kafka_events(
            spark, args.bootstrap_servers, args.topic, starting_offsets=args.starting_offsets,
            max_offsets_per_trigger=args.max_offsets_per_trigger,
        )
    trigger = {"processingTime": args.interval} if args.interval else None
    if args.command == "land":
        started = [
            land_events(events, args.output_path, args.checkpoint, trigger, args.files_per_day)
        ]
    elif args.whole:
        started = [
            whole.start_whole(
                events, args.output_path, f"{args.checkpoint}/whole", args.gap_seconds, args.watermark, trigger=trigger
            ),
            start_append(
                rejected_times(events), f"{args.output_path}/rejected", f"{args.checkpoint}/rejected", trigger
            ),
        ]
    else:
        started = stream_features(
            events, args.output_path, args.checkpoint, args.watermark, args.gap_seconds,
            trigger=trigger,
        )
    for query in started:
        query.awaitTermination()


if __name__ == "__main__":
    main()
