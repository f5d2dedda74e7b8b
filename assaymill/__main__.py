"""Command line: run one job of the lake.

    python -m assaymill validate --root hdfs:///lake --source ecommerce
    python -m assaymill silver   --root hdfs:///lake --fail-on-audit
    python -m assaymill gold     --root hdfs:///lake --reference-date 2018-10-17
    python -m assaymill incremental --root hdfs:///lake
    python -m assaymill vacuum   --root hdfs:///lake --keep 2
    python -m assaymill fold     --root hdfs:///lake
    python -m assaymill compact  --root hdfs:///lake --table weather_events
    python -m assaymill stream   --root hdfs:///lake --servers host:9092 --topic weather_events
    python -m assaymill stream-enrich --root hdfs:///lake --servers host:9092 --topic weather_events
    python -m assaymill load     --root hdfs:///lake --csv hdfs:///in --only customers,orders
    python -m assaymill sync     --root hdfs:///lake --url jdbc:... --option user=reader --sync-date 2018-10-17

``--versioned`` makes silver and gold publish versions and the stream write the merge-on-read view;
``incremental``, ``vacuum`` and ``fold`` work on those only. ``stream-enrich`` joins readings with the
gold layer's daily orders as they stand at each micro-batch, and keeps late readings aside. With ``spark-submit``, pass the zipped package as ``--py-files`` and this file as the script.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from assaymill.functions.timestamps import date_key
from assaymill.operators import validation, weather
from assaymill.plans import incremental, jobs, sync
from assaymill.session import build_session
from assaymill.sources import loads
from assaymill.sources.schemas import RAW_TABLES
from assaymill.sources.tables import Lake, compact_small_files
from assaymill.sources.versions import VersionedLake
from assaymill.streaming import enrichment, events, lateness
from assaymill.streaming.merge_view import MergeOnReadView, batch_at, batch_of
from assaymill.streaming.unified import UnifiedView

TABLE = "weather_events"


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="assaymill")
    jobs_there = ["validate", "silver", "gold", "incremental", "vacuum", "compact", "stream", "fold"]
    jobs_there += ["stream-enrich", "load", "sync"]
    parser.add_argument("job", choices=jobs_there)
    parser.add_argument("--root", required=True, help="folder that holds the lake's layers")
    parser.add_argument("--table-prefix", default="")
    parser.add_argument("--mode", choices=["local", "single", "cluster"], default="cluster")
    parser.add_argument("--source", choices=["ecommerce", "weather", "all"], default="all")
    parser.add_argument("--register-version", type=int, help="record the observed schemas")
    parser.add_argument("--fail-on-audit", action="store_true")
    parser.add_argument("--versioned", action="store_true", help="publish versions of a layer")
    parser.add_argument("--keep", type=int, default=2, help="versions that vacuum keeps")
    parser.add_argument("--reference-date", default="2018-10-17")
    parser.add_argument("--table", default=TABLE)
    parser.add_argument("--only", default="", help="raw tables to load, separated by commas")
    parser.add_argument("--csv", help="folder with <table>.csv for each table to load")
    parser.add_argument("--url", help="database to sync from")
    parser.add_argument("--option", action="append", default=[], help="name=value for the database reader")
    parser.add_argument("--sync-date", help="day the synced rows are filed under")
    parser.add_argument("--delay", default="2 hours", help="how late a reading may come")
    parser.add_argument("--servers")
    parser.add_argument("--topic", default=TABLE)
    parser.add_argument("--trigger", default="30 seconds")
    return parser.parse_args(argv)


def run_validate(spark, lake: Lake, args: argparse.Namespace) -> int:
    declared = {
        name: t for name, t in RAW_TABLES.items() if args.source in ("all", t.source)
    }
    paths = {name: lake.raw(t.source, name) for name, t in declared.items()}
    report = validation.validate_source(spark, paths, declared)
    report.orderBy("table_name", "check_name").show(len(paths) * 4, truncate=False)
    if args.register_version is not None:
        readable = {n: validation.read_if_exists_recursive(spark, p) for n, p in paths.items()}
        validation.register_schemas(
            {n: df for n, df in readable.items() if df is not None},
            f"{lake.root}/schema_registry",
            args.register_version,
        )
    return 0 if report.filter(~F.col("passed")).isEmpty() else 1


def merged_view(spark, lake: VersionedLake) -> MergeOnReadView:
    batch = batch_of(lake.layer(spark, "silver"), "weather_enriched")
    return MergeOnReadView(f"{lake.silver_stream('weather_unified')}", batch)


def run_stream(spark, lake: Lake, args: argparse.Namespace) -> int:
    """Raw log and unified view as two queries, until one of them ends."""
    trigger = {"processingTime": args.trigger}
    checkpoints = f"{lake.root}/_checkpoints"

    def decoded(session):
        source = events.stream_source(session, "kafka", servers=args.servers, topic=args.topic)
        return events.decode_events(source)

    raw = events.raw_stream_append(
        decoded(spark),
        lake.raw_stream(TABLE),
        f"{checkpoints}/streaming_raw",
        trigger=trigger,
        wait=False,
    )
    live = weather.conform_weather(
        events.well_formed(decoded(events.stateful_session(spark)))
    )
    kept = events.within_watermark(live, "datetime_utc", ["city_name", "unix_timestamp"])
    if isinstance(lake, VersionedLake):
        view = merged_view(spark, lake)
    else:
        view = UnifiedView(
            lake.silver("weather_enriched"),
            lake.silver_stream("weather_realtime"),
            lake.gold("lambda_weather_unified"),
        )
    drops = lateness.watch_drops(kept.sparkSession)
    unified = view.run(kept, f"{checkpoints}/streaming_unified", trigger, wait=False)
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in (raw, unified):
            query.stop()
        for query_id, total in drops.totals.items():
            print(f"{query_id}: {dict(total)}")
    return 0


def run_enrich(spark, lake: Lake, args: argparse.Namespace, stream=None, trigger=None, wait=False):
    """Readings with their day's orders into ``processed-streaming``; late ones into a side table."""
    if stream is None:
        source = events.stream_source(spark, "kafka", servers=args.servers, topic=args.topic)
        stream = weather.conform_weather(events.well_formed(events.decode_events(source)))
    name = "kpi_weather_sales_impact"
    if isinstance(lake, VersionedLake):
        sales = batch_of(lake.layer(spark, "gold"), name)
    else:
        sales = batch_at(lake.gold(name))
    sales = enrichment.columns_of(sales, ["date_key", "total_orders"])
    root = lake.silver_stream("weather_sales")
    sink = MergeOnReadView(root, enrichment.no_batch)
    ledger = lateness.LateLedger(f"{root}_late", "datetime_utc", args.delay)
    follower = enrichment.StaticFollower(sales, "date_key")
    return ledger.run(
        stream.withColumn("date_key", date_key("datetime_utc")),
        follower.into(sink.append),
        f"{lake.root}/_checkpoints/streaming_enriched",
        trigger or {"processingTime": args.trigger},
        wait,
    )


def run_loads(spark, lake: Lake, args: argparse.Namespace) -> int:
    names = [n for n in args.only.split(",") if n]
    declared = sync.chosen(args.source, names)
    if args.job == "load":
        rejects = sync.run_load(spark, lake, args.csv, declared)
        for name, n in rejects.items():
            print(f"{name}: {n} unreadable rows")
        return 1 if any(rejects.values()) else 0
    options = dict(o.split("=", 1) for o in args.option)
    done = sync.run_sync(
        lake, lambda name: loads.jdbc_source(spark, args.url, name, **options), declared, args.sync_date
    )
    for name, way in done.items():
        print(f"{name}: {way}")
    return 0


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    spark = build_session(f"assaymill-{args.job}", args.mode)
    versioned = args.versioned or args.job in ("incremental", "vacuum", "fold")
    lake = (VersionedLake if versioned else Lake)(args.root.rstrip("/"), args.table_prefix)
    if args.job == "validate":
        return run_validate(spark, lake, args)
    if args.job == "silver":
        options = jobs.SilverOptions(fail_on_audit=args.fail_on_audit)
        jobs.run_silver(spark, lake, options).show(truncate=False)
    elif args.job == "gold":
        jobs.run_gold(spark, lake, args.reference_date)
    elif args.job == "incremental":
        incremental.run_incremental(spark, lake, jobs.SilverOptions(fail_on_audit=args.fail_on_audit))
    elif args.job == "vacuum":
        for name in ("silver", "gold"):
            lake.layer(spark, name).vacuum(args.keep)
        merged_view(spark, lake).expire(spark)
    elif args.job == "fold":
        merged_view(spark, lake).fold(spark)
    elif args.job == "compact":
        source = lake.raw_stream(args.table)
        compact_small_files(spark, source, f"{source}_compacted")
    elif args.job in ("load", "sync"):
        return run_loads(spark, lake, args)
    elif args.job == "stream-enrich":
        run_enrich(spark, lake, args).awaitTermination()
    else:
        return run_stream(spark, lake, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
