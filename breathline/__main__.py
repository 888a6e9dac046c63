"""The jobs from the command line:

    spark-submit ... breathline/__main__.py realtime --servers host:9092 --dimension cities.json --table /data/m --checkpoint /data/c/m
    spark-submit ... breathline/__main__.py archive --servers host:9092 --table /data/raw --checkpoint /data/c/raw
    spark-submit ... breathline/__main__.py hourly --source /data/m --table /data/hourly --since 2024-05-01T03
    spark-submit ... breathline/__main__.py daily --source /data/hourly --table /data/daily
    spark-submit ... breathline/__main__.py hourly-stream --servers host:9092 --table /data/hourly --checkpoint /data/c/h
    spark-submit ... breathline/__main__.py moments --servers host:9092 --table /data/moments --checkpoint /data/c/mo
    spark-submit ... breathline/__main__.py alerts --servers host:9092 --table /data/alerts --checkpoint /data/c/a
    spark-submit ... breathline/__main__.py compact --kind measurements --table /data/m --before 2024-05-01
    spark-submit ... breathline/__main__.py cluster --source /data/m --table /data/m-by-city/2024-05 --since 2024-05-01 --before 2024-06-01
    spark-submit ... breathline/__main__.py replay --source /data/raw --dimension cities.json --table /data/m
    spark-submit ... breathline/__main__.py replay-stream --source /data/raw --servers host:9092 --dimension cities.json --table /data/m --checkpoint /data/c/m
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import date, datetime

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession

from breathline.functions.clock import LOCAL_OFFSET_HOURS
from breathline.functions.names import TOPIC_PREFIX
from breathline.plans import jobs
from breathline.session import builder, prepare
from breathline.sources.broker import Security, broker_options, read_broker
from breathline.sources.files import read_dimension
from breathline.streaming import run


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="breathline")
    commands = parser.add_subparsers(dest="job", required=True)
    for name, trigger in (
        ("realtime", run.REALTIME_TRIGGER), ("archive", run.ARCHIVE_TRIGGER), ("hourly-stream", run.REALTIME_TRIGGER),
        ("moments", run.REALTIME_TRIGGER), ("alerts", run.REALTIME_TRIGGER), ("replay-stream", run.REALTIME_TRIGGER),
    ):
        stream = commands.add_parser(name)
        stream.add_argument("--servers", required=True)
        stream.add_argument("--cities", nargs="*", help="all topics below the prefix if left out")
        stream.add_argument("--prefix", default=TOPIC_PREFIX)
        stream.add_argument("--protocol", default="PLAINTEXT")
        stream.add_argument("--mechanism", default="PLAIN")
        stream.add_argument("--username", default="")
        stream.add_argument("--password-file", help="file that holds the password")
        stream.add_argument("--max-offsets-per-trigger", type=int)
        stream.add_argument("--min-partitions", type=int)
        stream.add_argument("--table", required=True)
        stream.add_argument("--checkpoint", required=True)
        stream.add_argument("--trigger", default=trigger)
    for name in ("hourly-stream", "alerts"):
        commands.choices[name].add_argument("--delay", default="1 day", help="how late a reading may come")
    compact = commands.add_parser("compact")
    compact.add_argument("--kind", choices=["measurements", "moments", "archive"], required=True)
    compact.add_argument("--table", required=True)
    compact.add_argument("--before", type=date.fromisoformat, required=True, help="dates before this are compacted")
    cluster = commands.add_parser("cluster")
    cluster.add_argument("--source", required=True)
    cluster.add_argument("--table", required=True)
    cluster.add_argument("--since", type=date.fromisoformat, help="first processing date")
    cluster.add_argument("--before", type=date.fromisoformat, help="dates before this are clustered")
    for name in ("hourly", "daily", "replay"):
        batch = commands.add_parser(name)
        batch.add_argument("--source", required=True)
        batch.add_argument("--table", required=True)
    commands.choices["replay-stream"].add_argument("--source", required=True, help="the archive")
    commands.choices["replay-stream"].add_argument(
        "--partitions", type=int, help="of each city's topic: the live stream then begins where the archive ends"
    )
    commands.choices["realtime"].add_argument("--metrics", help="table of counts for each batch")
    for name in ("hourly", "daily"):
        commands.choices[name].add_argument(
            "--since", type=datetime.fromisoformat, help="local time; the whole history if left out"
        )
    commands.choices["hourly"].add_argument("--drop-copies", action="store_true", help="store each message once")
    for name in ("realtime", "replay", "replay-stream"):
        commands.choices[name].add_argument("--dimension", required=True)
    commands.choices["replay"].add_argument("--only-missing", action="store_true", help="leave out what the table has")
    for name in ("archive", "replay", "replay-stream", "compact"):
        commands.choices[name].add_argument("--format", choices=["json", "parquet"], default="json")
    for name in ("realtime", "replay", "replay-stream", "hourly", "daily"):
        commands.choices[name].add_argument("--name", help="the table's name in the catalog, made if missing")
    for name in ("realtime", "replay", "replay-stream", "hourly-stream", "moments", "alerts", "hourly"):
        commands.choices[name].add_argument("--offset-hours", type=int, default=LOCAL_OFFSET_HOURS)
    for name in ("realtime", "replay", "replay-stream", "hourly-stream", "moments", "alerts"):
        commands.choices[name].add_argument("--event-time", choices=["broker", "payload"], default="broker")
    return parser.parse_args(given)


def messages(
    spark: SparkSession, chosen: argparse.Namespace, starting: dict[str, dict[str, int]] | None = None
) -> DataFrame:
    password = ""
    if chosen.password_file:
        with open(chosen.password_file) as file:
            password = file.read().strip()
    return read_broker(spark, broker_options(
        chosen.servers, chosen.cities, chosen.prefix,
        Security(chosen.protocol, chosen.mechanism, chosen.username, password),
        chosen.max_offsets_per_trigger, chosen.min_partitions, starting,
    ))


def start(spark: SparkSession, chosen: argparse.Namespace) -> None:
    prepare(spark)
    if chosen.job == "realtime":
        dimension = read_dimension(spark, chosen.dimension)
        run.await_stop(jobs.run_realtime(
            messages(spark, chosen), dimension, chosen.table, chosen.checkpoint, chosen.trigger, chosen.offset_hours,
            chosen.event_time, chosen.name, chosen.metrics,
        ))
    elif chosen.job == "replay-stream":
        topics = [f"{chosen.prefix}.{city}" for city in chosen.cities or []]
        run.await_stop(jobs.run_replay_stream(
            spark, chosen.source, lambda starting: messages(spark, chosen, starting), read_dimension(spark, chosen.dimension),
            chosen.table, chosen.checkpoint, chosen.format, chosen.trigger, chosen.offset_hours, chosen.event_time,
            chosen.name, dict.fromkeys(topics, chosen.partitions) if chosen.partitions else None,
        ))
    elif chosen.job == "archive":
        run.await_stop(jobs.run_archive(
            messages(spark, chosen), chosen.table, chosen.checkpoint, chosen.format, chosen.trigger
        ))
    elif chosen.job == "hourly-stream":
        run.await_stop(jobs.run_hourly_stream(
            messages(spark, chosen), chosen.table, chosen.checkpoint, chosen.delay, chosen.trigger,
            chosen.offset_hours, chosen.event_time,
        ))
    elif chosen.job == "replay":
        jobs.run_replay(
            spark, chosen.source, read_dimension(spark, chosen.dimension), chosen.table, chosen.format, None,
            chosen.offset_hours, chosen.event_time, chosen.name, chosen.only_missing,
        )
    elif chosen.job == "moments":
        run.await_stop(jobs.run_moments(
            messages(spark, chosen), chosen.table, chosen.checkpoint, chosen.trigger, chosen.offset_hours, chosen.event_time,
        ))
    elif chosen.job == "alerts":
        run.await_stop(jobs.run_alerts(
            messages(spark, chosen), chosen.table, chosen.checkpoint, chosen.delay, chosen.trigger, chosen.offset_hours,
            chosen.event_time,
        ))
    elif chosen.job == "compact":
        if chosen.kind == "archive":
            jobs.compact_archive(spark, chosen.table, chosen.before, chosen.format)
        else:
            made = {"measurements": jobs.compact_measurements, "moments": jobs.compact_moments}
            made[chosen.kind](spark, chosen.table, chosen.before)
    elif chosen.job == "cluster":
        jobs.cluster_measurements(spark, chosen.source, chosen.table, chosen.since, chosen.before)
    elif chosen.job == "hourly":
        jobs.run_hourly(
            spark, chosen.source, chosen.table, chosen.since, chosen.drop_copies, chosen.offset_hours, chosen.name
        )
    else:
        jobs.run_daily(spark, chosen.source, chosen.table, chosen.since, chosen.name)


if __name__ == "__main__":
    options = arguments()
    start(builder(f"breathline {options.job}").getOrCreate(), options)
