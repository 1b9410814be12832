"""Scheduled jobs: ``spark-submit scripts/jobs.py <command> [options]``.

  medallion --bronze PATH --root DIR             staging view, silver and gold tables under DIR
  quality                                        the nine data tests over the last build; exit status 1 on any failure
  serve     --silver PATH --store DIR --batch-id N [--as-of TS]
                                                 one incremental serving load (no-op if N is committed)
  expire    --archive DIR [--as-of TS]           delete archive hours older than 14 days

Streams, each until stopped, or with --once over what is there now:

  ingest    --topic T --out DIR --rejects DIR    raw messages -> source table
  append    --topic T --out DIR                  event topic -> relational table
  bronze    --topic T --out DIR --rejects DIR    change feed -> bronze, every 10 s
  silver    --bronze DIR --out DIR               bronze -> silver, every minute
  archive   --topic T --out DIR --records-per-file N [--clock arrival|event]
                                                 event topic -> hourly JSON archive
  serving   --silver DIR --store DIR             silver -> serving table, every minute
  current   --topic T --out DIR                  change feed -> latest image per id, every 10 s
  latest    --silver DIR --out DIR               silver -> newest reading per device
  distinct  --silver DIR --out DIR --delay D     silver -> the same without repeated (device, event time)
  daily     --silver DIR --out DIR --delay D     silver -> gold, each day once its end is D behind the newest event
  hourly    --silver DIR --out DIR --delay D     silver -> events per device and hour, likewise

A topic comes from --bootstrap BROKERS (Kafka), or from --folder DIR with a
folder of JSON lines for each topic; --checkpoint DIR is the stream's own.
For raw messages a record's key is the MQTT topic and its value the payload.

The master and cluster sizing come from spark-submit; geofleet's session
defaults are applied on top, and partitions are sized from the input's bytes.
``--as-of`` defaults to the current UTC time.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from geofleet.operators import archive as A  # noqa: E402
from geofleet.operators import quality as Q  # noqa: E402
from geofleet.plans.medallion_build import build_medallion, built_tables  # noqa: E402
from geofleet.plans.serving_job import ServingStore, load_increment  # noqa: E402
from geofleet.session import build_session, size_for  # noqa: E402
from geofleet.sources.topics import read_topic  # noqa: E402
from geofleet.streaming import jobs as J  # noqa: E402
from geofleet.streaming import state as W  # noqa: E402


def _as_of(text: str | None) -> dt.datetime:
    if text:
        return dt.datetime.fromisoformat(text)
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


BATCH = {"medallion": "bronze root", "quality": "", "serve": "silver store", "expire": "archive"}
STREAMS = {"ingest": "topic out rejects", "append": "topic out", "bronze": "topic out rejects", "silver": "bronze out", "archive": "topic out",
           "serving": "silver store", "current": "topic out", "latest": "silver out", "distinct": "silver out delay", "daily": "silver out delay",
           "hourly": "silver out delay"}


def parse(argv: list[str]) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="jobs.py")
    sub = ap.add_subparsers(dest="command", required=True)
    parsers = {name: sub.add_parser(name) for name in (*BATCH, *STREAMS)}
    for name, options in (BATCH | STREAMS).items():
        for option in options.split():
            parsers[name].add_argument(f"--{option}", required=True)
    parsers["serve"].add_argument("--batch-id", type=int, required=True)
    for name in ("serve", "expire"):
        parsers[name].add_argument("--as-of")
    for name, options in STREAMS.items():
        parsers[name].add_argument("--checkpoint", required=True)
        parsers[name].add_argument("--once", action="store_true")
        if "topic" in options:
            edge = parsers[name].add_mutually_exclusive_group(required=True)
            edge.add_argument("--bootstrap")
            edge.add_argument("--folder")
    parsers["archive"].add_argument("--records-per-file", type=int, required=True)
    parsers["archive"].add_argument("--clock", choices=("arrival", "event"), default="arrival")
    return ap.parse_args(argv)


def _stream(args: argparse.Namespace, spark):
    if hasattr(args, "topic"):
        records = read_topic(spark, args.topic, bootstrap=args.bootstrap, folder=args.folder)
    if args.command == "ingest":
        messages = records.select("msg_id", F.col("key").alias("topic"), F.col("value").alias("payload"))
        return J.ingest_stream(messages, args.out, args.rejects, args.checkpoint, args.once)
    if args.command == "append":
        return J.table_sink_stream(records, args.out, args.checkpoint, args.once)
    if args.command == "bronze":
        return J.bronze_stream(records, args.out, args.rejects, args.checkpoint, args.once)
    if args.command == "archive":
        return J.archive_stream(records, args.out, args.checkpoint, args.records_per_file, args.clock, args.once)
    if args.command == "silver":
        return J.silver_stream(J.table_stream(spark, args.bronze), args.out, args.checkpoint, args.once)
    if args.command == "current":
        return W.current_images_stream(records.withColumnRenamed("msg_id", "position"), args.out, args.checkpoint, args.once)
    if args.command == "latest":
        return W.latest_position_stream(J.table_stream(spark, args.silver), args.out, args.checkpoint, args.once)
    if args.command in ("distinct", "daily", "hourly"):
        start = {"distinct": W.distinct_stream, "daily": W.daily_stream, "hourly": W.hourly_stream}[args.command]
        return start(J.table_stream(spark, args.silver), args.out, args.checkpoint, args.delay, available_now=args.once)
    return J.serving_stream(J.table_stream(spark, args.silver), ServingStore(spark, args.store), args.checkpoint, args.once)


def main(argv: list[str], spark=None) -> int:
    args = parse(argv)
    spark = spark or build_session(app_name=f"geofleet-{args.command}")
    if args.command in STREAMS:
        _stream(args, spark).awaitTermination()
    elif args.command == "medallion":
        size_for(spark, args.bronze)
        print(build_medallion(spark, args.bronze, args.root))
    elif args.command == "quality":
        built = built_tables(spark)
        failing = Q.failing(Q.run_checks({"iot_validated": built["silver"], "device_daily": built["gold"]})).collect()  # at most nine rows
        for row in failing:
            print(f"FAIL {row.check_name} {row.model}.{row.column_name}: {row.failures}")
        return 1 if failing else 0
    elif args.command == "serve":
        done = load_increment(ServingStore(spark, args.store), spark.read.parquet(args.silver), _as_of(args.as_of), args.batch_id)
        print("loaded" if done else "already committed")
    elif args.command == "expire":
        print(f"deleted {A.expire_archive(spark, args.archive, _as_of(args.as_of))} hours")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
