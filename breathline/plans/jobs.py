"""The four jobs, one run for all cities. None of them creates or stops a session."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from breathline import workspace
from breathline.functions.clock import LOCAL_OFFSET_HOURS
from breathline.operators.archive import FOLDERS, OPTIONS
from breathline.operators.dedup import drop_replays
from breathline.operators.intervals import not_within, offset_intervals
from breathline.operators.moments import MOMENTS, STORED_MOMENTS, fold_moments, hours_of
from breathline.operators.parse import parse
from breathline.operators.replace import replace_by_key
from breathline.operators.rollup import DAILY_KEYS, HOURLY_KEYS, daily, hourly
from breathline.schema import ARCHIVE_STORED, HOURLY, METRICS, RECORD_ID, STORED
from breathline.session import prepare
from breathline.sinks.clustering import files_for, read_clustered, write_clustered
from breathline.sinks.compaction import TARGET_BYTES, compact, owner_folders
from breathline.sinks.tables import ensure_table
from breathline.sources.files import replay_archive, stream_archive
from breathline.streaming import run
from breathline.streaming.flows import (
    alert_sink, alert_stream, archive_sink, hourly_sink, hourly_stream, measurement_sink, metered, moments_sink, realtime,
)
from breathline.streaming.handover import ARCHIVE_PHASE, LIVE_PHASE, held_intervals, once_sink, starting_offsets

# Keys of the clustered measurement table.
CLUSTERED_BY = ["city", "measurement_time"]


def run_realtime(
    records: DataFrame, dimension: DataFrame, path: str, checkpoint: str, trigger: str | None = run.REALTIME_TRIGGER,
    offset_hours: int = LOCAL_OFFSET_HOURS, event_time: str = "broker", name: str | None = None,
    metrics: str | None = None,
) -> StreamingQuery:
    """``name``, here and below, is the table's name in the catalog, made if it is missing. ``metrics`` is a table that gets
    a row of counts for each batch."""
    prepare(records.sparkSession)
    rows = realtime(records, dimension, offset_hours, event_time=event_time)
    sink = measurement_sink(path, name=name)
    return run.start(rows, metered(sink, metrics) if metrics else sink, checkpoint, trigger)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).parquet(path)


def run_archive(
    records: DataFrame, path: str, checkpoint: str, fmt: str = "json", trigger: str | None = run.ARCHIVE_TRIGGER
) -> StreamingQuery:
    prepare(records.sparkSession)
    return run.start(records, archive_sink(path, fmt), checkpoint, trigger)


def run_hourly_stream(
    records: DataFrame, path: str, checkpoint: str, delay: str, trigger: str | None = run.REALTIME_TRIGGER,
    offset_hours: int = LOCAL_OFFSET_HOURS, event_time: str = "broker",
) -> StreamingQuery:
    """Messages to the hourly table, hour by hour as they change. Readings later than ``delay`` are left to
    ``run_hourly`` with ``since``, to be run once in a while over the measurement table."""
    spark = prepare(records.sparkSession)
    flat = parse(records, offset_hours, event_time=event_time)
    return run.start(hourly_stream(flat, delay), hourly_sink(spark, path), checkpoint, trigger, mode="update")


def run_moments(
    records: DataFrame, path: str, checkpoint: str, trigger: str | None = run.REALTIME_TRIGGER,
    offset_hours: int = LOCAL_OFFSET_HOURS, event_time: str = "broker",
) -> StreamingQuery:
    """Messages to partial moments by hour: no state, no table rewritten, no reading too late."""
    prepare(records.sparkSession)
    return run.start(parse(records, offset_hours, event_time=event_time), moments_sink(path), checkpoint, trigger)


def read_moments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED_MOMENTS).parquet(path)


def hours_from_moments(spark: SparkSession, path: str, since: datetime | None = None) -> DataFrame:
    """The hourly table's rows, folded from the moments of the dates from ``since`` on."""
    rows = read_moments(spark, path)
    if since is not None:
        first = since.replace(minute=0, second=0, microsecond=0)
        rows = rows.where((F.col("date") >= F.lit(first.date())) & (F.col("hour_start") >= F.lit(first)))
    return hours_of(fold_moments(rows))


def run_alerts(
    records: DataFrame, path: str, checkpoint: str, delay: str, trigger: str | None = run.REALTIME_TRIGGER,
    offset_hours: int = LOCAL_OFFSET_HOURS, event_time: str = "broker",
) -> StreamingQuery:
    """Messages to runs of alert hours. Readings later than ``delay`` are left out: ``insights.alert_runs`` over the hourly
    table has them."""
    prepare(records.sparkSession)
    rows = alert_stream(parse(records, offset_hours, event_time=event_time), delay)
    return run.start(rows, alert_sink(path), checkpoint, trigger)


def _before(day: date) -> Callable[[str], bool]:
    """Whether a folder's last part names a date before ``day``; the folder of rows without a date never does."""
    def closed(folder: str) -> bool:
        value = folder.rsplit("=", 1)[1]
        return re.fullmatch(r"\d{4}-\d\d-\d\d", value) is not None and value < day.isoformat()

    return closed


def compact_measurements(spark: SparkSession, path: str, before: date, target_bytes: int = TARGET_BYTES) -> list[str]:
    """Files of the processing dates before ``before``, a file per task and batch, into few. No stream repeats a batch
    of a date that far back, and none writes there again."""
    return compact(
        prepare(spark), path, STORED, ["processed_date"], ["city", "measurement_time"], _before(before), target_bytes
    )


def compact_moments(spark: SparkSession, path: str, before: date, target_bytes: int = TARGET_BYTES) -> list[str]:
    """The same for moments, whose rows become one per city and hour."""
    def fold(rows: DataFrame) -> DataFrame:
        return fold_moments(rows.select(*MOMENTS.names)).withColumn("date", F.to_date("hour_start"))

    return compact(prepare(spark), path, STORED_MOMENTS, ["date"], HOURLY_KEYS, _before(before), target_bytes, fold=fold)


def compact_archive(
    spark: SparkSession, path: str, before: date, fmt: str = "json", target_bytes: int = TARGET_BYTES
) -> list[str]:
    """The same for the archive's folders of a city and message date."""
    def closed(folder: str) -> bool:
        found = re.search(r"year=(\d+)/month=(\d+)/day=(\d+)$", folder)
        return found is not None and date(*map(int, found.groups())) < before

    return compact(
        prepare(spark), path, ARCHIVE_STORED, FOLDERS, ["partition", "kafka_offset"], closed, target_bytes, fmt, OPTIONS[fmt]
    )


def cluster_measurements(
    spark: SparkSession, source: str, path: str, since: date | None = None, before: date | None = None,
    target_bytes: int = TARGET_BYTES,
) -> int:
    """Measurements of the processing dates from ``since`` to before ``before`` (a closed month, say) as a table laid out by
    city and time, for scans of few cities over some time. Returns the number of files asked for."""
    rows = read_measurements(prepare(spark), source)
    chosen: Callable[[str], bool] = lambda folder: True
    if since is not None:
        rows = rows.where(F.col("processed_date") >= F.lit(since))
    if before is not None:
        rows = rows.where(F.col("processed_date") < F.lit(before))
    if since is not None or before is not None:
        first, end = (since or date.min).isoformat(), (before or date.max).isoformat()
        chosen = lambda folder: first <= folder.rsplit("=", 1)[1] < end
    listed = owner_folders(spark, source, ["processed_date"])
    size = sum(size for name, owners in listed.items() if chosen(name) for sizes in owners.values() for size in sizes)
    files = files_for(size, target_bytes)
    write_clustered(rows, path, CLUSTERED_BY, files)
    return files


def scan_measurements(
    spark: SparkSession, path: str, cities: tuple[str | None, str | None] = (None, None),
    times: tuple[datetime | None, datetime | None] = (None, None),
) -> DataFrame:
    """Rows of a clustered table by a range of cities and of times, ends included."""
    return read_clustered(spark, path, STORED, {"city": cities, "measurement_time": times})


def run_replay(
    spark: SparkSession, archive_path: str, dimension: DataFrame, path: str, fmt: str = "json",
    where: Column | None = None, offset_hours: int = LOCAL_OFFSET_HOURS, event_time: str = "broker",
    name: str | None = None, only_missing: bool = False,
) -> None:
    """Archived messages into the measurement table, below a folder of this replay. Rows that a stream has stored
    too are copies of them: roll up with ``drop_copies``, or replay ``only_missing`` messages, which reads the ids of the
    table first."""
    records = replay_archive(prepare(spark), archive_path, fmt, where)
    if only_missing and workspace.exists(spark, path):
        records = not_within(records, workspace.cut(offset_intervals(read_measurements(spark, path)), "intervals"))
    rows = realtime(records, dimension, offset_hours, event_time=event_time)
    measurement_sink(path, name=name, owner=f"replay-{uuid.uuid4().hex}")(rows, 0)


def run_replay_stream(
    spark: SparkSession, archive_path: str, live: Callable[[dict[str, dict[str, int]]], DataFrame], dimension: DataFrame,
    path: str, checkpoint: str, fmt: str = "json", trigger: str | None = run.REALTIME_TRIGGER,
    offset_hours: int = LOCAL_OFFSET_HOURS, event_time: str = "broker", name: str | None = None,
    partitions: Mapping[str, int] | None = None, max_files: int | None = None,
) -> StreamingQuery:
    """The archive into the measurement table, to its end, and then the live stream; returns the latter's query.

    ``live`` makes the live stream's messages from the offsets to begin with (none: the oldest). A run that stopped in
    either phase goes on where it was. The archive job may run on meanwhile: what it files after the hand-over
    comes from the live stream, so its retention must reach back to the hand-over.
    """
    prepare(spark)
    sink, held, handed = measurement_sink(path, name=name), f"{checkpoint}/held", f"{checkpoint}/handover"
    if not workspace.exists(spark, handed):
        if workspace.exists(spark, archive_path):
            archived = stream_archive(spark, archive_path, fmt, max_files=max_files)
            rows = realtime(archived, dimension, offset_hours, event_time=event_time)
            run.start(rows, once_sink(sink, held, ARCHIVE_PHASE), f"{checkpoint}/archive").awaitTermination()
        begin = starting_offsets(held_intervals(spark, held), partitions)
        workspace.write_text(spark, handed, json.dumps(begin))
    records = live(json.loads(workspace.read_text(spark, handed)))
    rows = realtime(records, dimension, offset_hours, event_time=event_time)
    return run.start(rows, once_sink(sink, held, LIVE_PHASE), f"{checkpoint}/live", trigger)


def read_measurements(spark: SparkSession, path: str, oldest: date | None = None) -> DataFrame:
    """The measurement table, or its partitions from a date on. Then only their folders are listed: after a
    year of micro-batches, listing all of them would take longer than reading one day."""
    reader = spark.read.schema(STORED)
    if oldest is None:
        return reader.parquet(path)
    first = f"processed_date={oldest.isoformat()}"
    chosen = [f"{path}/{name}" for name in workspace.folders(spark, path) if name >= first]
    return reader.option("basePath", path).parquet(*chosen) if chosen else spark.createDataFrame([], STORED)


def measurements_since(
    spark: SparkSession, path: str, since: datetime, offset_hours: int = LOCAL_OFFSET_HOURS
) -> DataFrame:
    """Rows of the local hours from ``since`` on. A reading is processed after the broker saw it, so older
    partitions cannot hold any of them; a day is left for clocks that disagree."""
    first = since.replace(minute=0, second=0, microsecond=0)
    oldest = (first - timedelta(days=1, hours=offset_hours)).date()
    return read_measurements(spark, path, oldest).where(F.col("measurement_time") >= F.lit(first))


def run_hourly(
    spark: SparkSession, measurements_path: str, path: str, since: datetime | None = None, drop_copies: bool = False,
    offset_hours: int = LOCAL_OFFSET_HOURS, name: str | None = None,
) -> None:
    """Recomputes the hours from ``since`` on, or all of them, and replaces them in the hourly table.

    ``drop_copies`` is for tables that a stream has read into twice, as after the loss of its checkpoint, or that
    a replay has filled: it shuffles every reading, which the roll-up alone does not.
    """
    prepare(spark)
    rows = (
        read_measurements(spark, measurements_path) if since is None
        else measurements_since(spark, measurements_path, since, offset_hours)
    )
    if drop_copies:
        needed = ["city", "aqi", "pm25", "pm10", "temperature", "humidity", "measurement_time"]
        rows = drop_replays(rows.select(*RECORD_ID, *needed))
    hours = hourly(rows).withColumn("date", F.to_date("hour_start"))
    touched = replace_by_key(spark, path, hours, HOURLY_KEYS, "date", HOURLY_KEYS)
    _named(spark, name, hours, "date", path, touched)


def _named(spark: SparkSession, name: str | None, rows: DataFrame, partition: str, path: str, touched: list) -> None:
    if name:
        ensure_table(spark, name, rows.schema, [partition], path, [(value,) for value in touched])


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(StructType([*HOURLY, StructField("date", DateType())])).parquet(path)


def run_daily(
    spark: SparkSession, hourly_path: str, path: str, since: datetime | None = None, name: str | None = None
) -> None:
    """Rolls the hourly table up from the day of ``since`` on and replaces those days. Days share a folder
    per month: a day is one row per city, too little for a file of its own."""
    prepare(spark)
    hours = read_hourly(spark, hourly_path)
    if since is not None:
        hours = hours.where(F.col("date") >= F.to_date(F.lit(since)))
    days = daily(hours).withColumn("month", F.date_format("date", "yyyy-MM"))
    touched = replace_by_key(spark, path, days, DAILY_KEYS, "month", ["date", "city"])
    _named(spark, name, days, "month", path, touched)
