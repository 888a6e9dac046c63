"""One query per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, TimestampType

from breathline import workspace
from breathline.functions import clock, ladders, names
from breathline.operators import archive, dedup, enrich, intervals, moments, parse, payload, publish, replace, rollup
from breathline.plans import forecast, insights, jobs, sql
from breathline.schema import DIMENSION, HOURLY, MEASUREMENT, RECORD, RECORD_ID
from breathline.session import prepare
from breathline.sources import files
from breathline.streaming import flows, run
from checks import fixture

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

# Last moment the earlier run of an incremental job knew of, within an hour of the test tables.
EARLIER_RUN = "2024-01-16 05:30:00"

# Dates before this are closed when the moments are compacted.
CLOSED = date(2024, 1, 20)

# Size of a clustered table's files, small enough that the test tables have several; and what is scanned of it.
CLUSTERED_BYTES = 1 << 17
SCANNED_CITIES = ("nation_12", "nation_14")
SCANNED_TIMES = (datetime(2024, 1, 9, 12), datetime(2024, 1, 14, 6, 30))


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six places and times without a zone, as the SQL side gives them. A mean of short decimals
    often lies exactly between two roundings, and the last bit of its sum depends on the order of the rows;
    the small addend, far above that bit, sends all such ties upwards on both sides."""
    shown = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DoubleType):
            column = F.round(column + 1e-10, 6)
        elif isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def register(query: Query) -> Query:
    @wraps(query)
    def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(query(prepare(spark), sf_dir))

    REGISTRY[query.__name__] = run_query
    return run_query


def hours_with_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.hourly(fixture.measurements(spark, sf_dir), counts=True)


# Files of published messages; a stream that takes one at a time runs as many micro-batches.
LANDED_FILES = 3

# Row groups of these files. A row group is read by one task, so a file of one would be one, however large.
LANDED_GROUP_BYTES = 8 << 20


def landed(spark: SparkSession, records: DataFrame, mode: str = "overwrite", path: str | None = None) -> str:
    """Messages published to a folder that a stream can read: the broker's place in these checks."""
    path = path or workspace.scratch(spark, "landing")
    dealt = records.select(*RECORD.names).repartition(LANDED_FILES)
    dealt.write.mode(mode).option("parquet.block.size", LANDED_GROUP_BYTES).parquet(path)
    return path


def span(records: DataFrame) -> str:
    """A delay that covers all messages, so that none counts as late whatever the order of the files."""
    low, high = records.agg(F.min("timestamp"), F.max("timestamp")).first()
    return f"{int((high - low).total_seconds()) + 3600} seconds"


def drained(spark: SparkSession, rows: DataFrame, sink: run.Sink, mode: str = "append") -> None:
    run.start(rows, sink, workspace.scratch(spark, "checkpoint"), mode=mode).awaitTermination()


# --- messages and rows ---------------------------------------------------------------------------------

@register
def publish_rows(spark, sf_dir):
    text = F.col("value").cast("string")
    return fixture.messages(spark, sf_dir).select(
        "offset",
        F.col("key").cast("string").alias("key"),
        "topic",
        F.get_json_object(text, "$.city").alias("city"),
        F.get_json_object(text, "$.payload.aqi").cast("int").alias("aqi"),
        F.get_json_object(text, "$.payload.idx").cast("int").alias("station_id"),
        F.get_json_object(text, "$.payload.dominentpol").alias("dominant_pollutant"),
        F.get_json_object(text, "$.payload.iaqi.pm25.v").cast("double").alias("pm25"),
        F.get_json_object(text, "$.payload.iaqi.pm10.v").cast("double").alias("pm10"),
        F.get_json_object(text, "$.payload.iaqi.t.v").cast("double").alias("temperature"),
        F.get_json_object(text, "$.payload.iaqi.h.v").cast("double").alias("humidity"),
        F.get_json_object(text, "$.payload.city.name").alias("station_name"),
        F.get_json_object(text, "$.payload.city.geo[0]").cast("double").alias("latitude"),
        F.get_json_object(text, "$.payload.city.geo[1]").cast("double").alias("longitude"),
    )


@register
def wrap_payload(spark, sf_dir):
    """Every event's raw properties as a feed payload."""
    wrapped = publish.wrap(F.col("event_type"), F.col("props"))
    return fixture.table(spark, sf_dir, "events").select(
        "event_id",
        F.get_json_object(wrapped, "$.city").alias("city"),
        F.get_json_object(wrapped, "$.payload.k").cast("int").alias("k"),
        F.md5(wrapped).alias("digest"),
    )


@register
def parse_envelope(spark, sf_dir):
    return parse.parse(fixture.messages(spark, sf_dir), keep=["offset"]).drop("processed_time")


@register
def quarantine(spark, sf_dir):
    checked = parse.parse_checked(fixture.messages_some_broken(spark, sf_dir), keep=["offset"])
    return checked.select("offset", "city", "aqi", "pm25", parse.is_rejected().alias("rejected"))


@register
def quarantine_reasons(spark, sf_dir):
    faulty = fixture.messages_faulty(spark, sf_dir)
    return payload.reasons(faulty).select("offset", "city", "reason", "bad_fields")


@register
def payload_fields(spark, sf_dir):
    """Every field of every message, found without the parser's schema."""
    return payload.payload_fields(fixture.messages_faulty(spark, sf_dir))


@register
def local_time(spark, sf_dir):
    return fixture.readings(spark, sf_dir).select(
        "offset", clock.local_time(F.col("timestamp")).alias("measurement_time")
    )


@register
def feed_slug(spark, sf_dir):
    """Every reading's feed address. The three cities whose address differs stand in for the first three."""
    stand_in = {"nation_0": "cantho", "nation_1": "nhatrang", "nation_2": "vungtau"}
    city = F.col("city")
    key = F.coalesce(*[F.when(city == old, new) for old, new in stand_in.items()], city)
    return fixture.readings(spark, sf_dir).select(
        "offset", names.feed_slug(key).alias("slug"), names.topic(key).alias("topic")
    )


@register
def health_status(spark, sf_dir):
    return fixture.readings(spark, sf_dir).select(
        "offset", "aqi", ladders.health_status(F.col("aqi")).alias("health_status")
    )


@register
def pollution_level(spark, sf_dir):
    return fixture.readings(spark, sf_dir).select(
        "offset", "pm25", "pm10", ladders.pollution_level(F.col("pm25"), F.col("pm10")).alias("pollution_level")
    )


@register
def classify(spark, sf_dir):
    return enrich.classify(fixture.readings(spark, sf_dir)).groupBy("health_status", "pollution_level").agg(
        F.count("*").alias("records")
    )


@register
def enrich_city(spark, sf_dir):
    rows = fixture.readings(spark, sf_dir).select("offset", "city", "aqi")
    return enrich.enrich_city(rows, fixture.dimension(spark, sf_dir))


@register
def health_by_city(spark, sf_dir):
    rows = fixture.readings(spark, sf_dir).select("offset", "city", "aqi")
    located = enrich.enrich_city(rows, fixture.dimension_own_bounds(spark, sf_dir))
    return located.select("offset", "city", ladders.health_status_by_city(F.col("aqi")).alias("health_status"))


@register
def enrich_as_of(spark, sf_dir):
    """Cities' bounds change in the middle of the data, each city's on a day of its own."""
    rows = fixture.measurements(spark, sf_dir).select("offset", "city", "aqi", "measurement_time")
    located = enrich.enrich_as_of(rows, fixture.dimension_history(spark, sf_dir))
    return located.select(
        "offset", "city", "city_name", "aqi_threshold_good", ladders.health_status_by_city(F.col("aqi")).alias("health_status")
    )


@register
def dedup_replay(spark, sf_dir):
    """All messages read twice, as by a stream that lost its checkpoint."""
    sent = fixture.messages(spark, sf_dir)
    once = dedup.drop_replays(sent.unionByName(sent))
    return parse.parse(once, keep=RECORD_ID).select(*RECORD_ID, "city", "aqi", "pm25", "measurement_time")


@register
def dedup_intervals(spark, sf_dir):
    """All messages replayed onto a table that holds some stretches of them."""
    sent = fixture.messages(spark, sf_dir)
    held = sent.where(F.floor(F.col("offset") / 700) % 3 != 1)
    missing = intervals.not_within(sent, workspace.cut(intervals.offset_intervals(held), "intervals"))
    once = held.unionByName(missing)
    return parse.parse(once, keep=RECORD_ID).select(*RECORD_ID, "city", "aqi", "pm25", "measurement_time")


@register
def held_intervals(spark, sf_dir):
    """The stretches themselves, from two tables that overlap."""
    sent = fixture.messages(spark, sf_dir)
    one = sent.where(F.floor(F.col("offset") / 700) % 3 == 0)
    two = sent.where(F.floor(F.col("offset") / 900) % 4 == 1)
    return intervals.merge_intervals(intervals.offset_intervals(one), intervals.offset_intervals(two))


# --- statistics ------------------------------------------------------------------------------------------

@register
def hourly_rollup(spark, sf_dir):
    return rollup.hourly(fixture.measurements(spark, sf_dir))


@register
def sql_hourly(spark, sf_dir):
    return sql.hourly_sql(spark, fixture.measurements(spark, sf_dir))


@register
def sql_daily(spark, sf_dir):
    return sql.daily_sql(spark, rollup.hourly(fixture.measurements(spark, sf_dir)))


@register
def daily_rollup(spark, sf_dir):
    return rollup.daily(rollup.hourly(fixture.measurements(spark, sf_dir)))


@register
def daily_weighted(spark, sf_dir):
    return rollup.daily_weighted(hours_with_counts(spark, sf_dir))


@register
def weekly_rollup(spark, sf_dir):
    return rollup.weekly(rollup.daily(rollup.hourly(fixture.measurements(spark, sf_dir))))


@register
def union_cities(spark, sf_dir):
    return rollup.of_cities(rollup.hourly(fixture.measurements(spark, sf_dir)), fixture.dimension(spark, sf_dir))


# --- tables ----------------------------------------------------------------------------------------------

def _runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Readings known to the earlier run, and those from the start of its last day on."""
    rows = fixture.measurements(spark, sf_dir)
    known = F.lit(EARLIER_RUN).cast("timestamp")
    return rows.where(F.col("measurement_time") <= known), rows.where(
        F.col("measurement_time") >= F.date_trunc("day", known)
    )


@register
def overlap_keys(spark, sf_dir):
    before, after = (rollup.hourly(rows) for rows in _runs(spark, sf_dir))
    return replace.overlap_keys(before, after, rollup.HOURLY_KEYS)


@register
def upsert_hourly(spark, sf_dir):
    path = workspace.scratch(spark, "hourly")
    for rows in _runs(spark, sf_dir):
        hours = rollup.hourly(rows).withColumn("date", F.to_date("hour_start"))
        replace.replace_by_key(spark, path, hours, rollup.HOURLY_KEYS, "date", rollup.HOURLY_KEYS)
    return jobs.read_hourly(spark, path).drop("date")


@register
def upsert_daily(spark, sf_dir):
    path = workspace.scratch(spark, "daily")
    for rows in _runs(spark, sf_dir):
        days = rollup.daily(rollup.hourly(rows)).withColumn("month", F.date_format("date", "yyyy-MM"))
        replace.replace_by_key(spark, path, days, rollup.DAILY_KEYS, "month", ["date", "city"])
    return spark.read.schema(days.schema).parquet(path).drop("month")


@register
def measurements_sink(spark, sf_dir):
    path = workspace.scratch(spark, "measurements")
    rows = flows.realtime(
        fixture.messages(spark, sf_dir), fixture.dimension(spark, sf_dir), processed_time=F.col("timestamp")
    )
    flows.measurement_sink(path)(rows, 0)
    return jobs.read_measurements(spark, path).select(*rows.columns).drop("topic", "partition")


@register
def batch_jobs(spark, sf_dir):
    """Stored measurements to stored hours to stored days."""
    paths = [workspace.scratch(spark, name) for name in ("measurements", "hourly", "daily")]
    rows = flows.realtime(
        fixture.messages(spark, sf_dir), fixture.dimension(spark, sf_dir), processed_time=F.col("timestamp")
    )
    flows.measurement_sink(paths[0])(rows, 0)
    jobs.run_hourly(spark, paths[0], paths[1])
    jobs.run_daily(spark, paths[1], paths[2])
    return spark.read.parquet(paths[2]).drop("month")


@register
def archive_rows(spark, sf_dir):
    path = workspace.scratch(spark, "archive")
    archive.write_archive(fixture.messages(spark, sf_dir), path)
    stored = files.read_archive(spark, path)
    return stored.select(
        "city", "year", "month", "day", "topic", "kafka_offset", "kafka_timestamp",
        F.get_json_object("json_data", "$.payload.idx").cast("int").alias("station_id"),
    )


def _archived():
    """What a folder of the archive holds: messages, and what their texts say."""
    said = {"stations": "$.payload.idx", "index_total": "$.payload.aqi"}
    return [
        F.count("*").alias("records"), F.min("kafka_offset").alias("first_offset"),
        F.max("kafka_timestamp").alias("last_time"),
        *[F.sum(F.get_json_object("json_data", path).cast("bigint")).alias(name) for name, path in said.items()],
        F.count_if(F.get_json_object("json_data", "$.city") == F.col("city")).alias("of_the_city"),
    ]


@register
def archive_parquet(spark, sf_dir):
    path = workspace.scratch(spark, "archive")
    archive.write_archive(fixture.messages(spark, sf_dir), path, fmt="parquet")
    return files.read_archive(spark, path, fmt="parquet").groupBy("city", "year", "month", "day").agg(
        *_archived()
    )


@register
def archive_replay(spark, sf_dir):
    path = workspace.scratch(spark, "archive")
    archive.write_archive(fixture.messages(spark, sf_dir), path, fmt="parquet")
    return parse.parse(files.replay_archive(spark, path, fmt="parquet"), keep=["offset"]).drop("processed_time")


@register
def archive_bundle(spark, sf_dir):
    bundled = archive.bundle(fixture.messages(spark, sf_dir))
    messages = F.from_json("body", "array<string>")
    stations = F.transform(messages, lambda text: F.get_json_object(text, "$.payload.idx"))
    return bundled.withColumn("stations", F.array_join(stations, ",")).withColumn("elements", F.size(messages)).drop("body")


# --- streams -----------------------------------------------------------------------------------------------

@register
def stream_enrich(spark, sf_dir):
    """The realtime job, from published messages to the stored table."""
    path = workspace.scratch(spark, "measurements")
    stream = files.stream_messages(spark, landed(spark, fixture.messages(spark, sf_dir)), max_files=1)
    rows = flows.realtime(stream, fixture.dimension(spark, sf_dir))
    drained(spark, rows, flows.measurement_sink(path))
    shown = [name for name in MEASUREMENT.names if name != "processed_time"] + ["health_status", "pollution_level"]
    return jobs.read_measurements(spark, path).select("offset", *shown, *DIMENSION.names[1:])


@register
def stream_archive(spark, sf_dir):
    path = workspace.scratch(spark, "archive")
    drained(
        spark,
        files.stream_messages(spark, landed(spark, fixture.messages(spark, sf_dir)), max_files=1),
        flows.archive_sink(path),
    )
    return files.read_archive(spark, path).groupBy("city", "year", "month", "day").agg(
        *_archived()
    )


@register
def stream_dedup(spark, sf_dir):
    """All messages published twice."""
    path = workspace.scratch(spark, "measurements")
    landing = landed(spark, fixture.messages(spark, sf_dir))
    landed(spark, fixture.messages(spark, sf_dir), mode="append", path=landing)
    delay = span(spark.read.parquet(landing))
    once = dedup.drop_replays_stream(files.stream_messages(spark, landing), "timestamp", delay)
    rows = flows.realtime(once, fixture.dimension(spark, sf_dir))
    drained(spark, rows, flows.measurement_sink(path))
    return jobs.read_measurements(spark, path).select(*RECORD_ID, "city", "aqi", "pm25", "measurement_time")


@register
def stream_hourly(spark, sf_dir):
    path = workspace.scratch(spark, "hourly")
    landing = landed(spark, fixture.messages(spark, sf_dir))
    delay = span(spark.read.parquet(landing))
    hours = flows.hourly_stream(parse.parse(files.stream_messages(spark, landing)), delay)
    drained(spark, hours, flows.hourly_sink(spark, path), mode="update")
    return jobs.read_hourly(spark, path).select(*HOURLY.names)


@register
def moments_hourly(spark, sf_dir):
    """Hours folded from what each micro-batch appended, once more after old dates were compacted."""
    path = workspace.scratch(spark, "moments")
    stream = files.stream_messages(spark, landed(spark, fixture.messages(spark, sf_dir)), max_files=1)
    drained(spark, parse.parse(stream), flows.moments_sink(path))
    jobs.compact_moments(spark, path, CLOSED)
    return jobs.hours_from_moments(spark, path)


@register
def compact_measurements(spark, sf_dir):
    """The realtime job's table after its dates were compacted."""
    path = workspace.scratch(spark, "measurements")
    stream = files.stream_messages(spark, landed(spark, fixture.messages(spark, sf_dir)), max_files=1)
    rows = flows.realtime(stream, fixture.dimension(spark, sf_dir))
    drained(spark, rows, flows.measurement_sink(path))
    jobs.compact_measurements(spark, path, date.max)
    shown = [name for name in MEASUREMENT.names if name != "processed_time"] + ["health_status", "pollution_level"]
    return jobs.read_measurements(spark, path).select("offset", *shown, *DIMENSION.names[1:])


def clustered(spark: SparkSession, sf_dir: str) -> str:
    """The realtime job's table, laid out by city and time."""
    source, path = workspace.scratch(spark, "measurements"), workspace.scratch(spark, "clustered")
    rows = flows.realtime(fixture.messages(spark, sf_dir), fixture.dimension(spark, sf_dir))
    flows.measurement_sink(source, owner="checks")(rows, 0)
    jobs.cluster_measurements(spark, source, path, target_bytes=CLUSTERED_BYTES)
    return path


@register
def clustered_rows(spark, sf_dir):
    """Every row of the clustered table."""
    shown = [name for name in MEASUREMENT.names if name != "processed_time"] + ["health_status", "pollution_level"]
    return jobs.scan_measurements(spark, clustered(spark, sf_dir)).select("offset", *shown, *DIMENSION.names[1:])


@register
def clustered_scan(spark, sf_dir):
    """Some cities over some days, from the files whose zones meet both."""
    found = jobs.scan_measurements(spark, clustered(spark, sf_dir), SCANNED_CITIES, SCANNED_TIMES)
    return found.select("offset", *[name for name in MEASUREMENT.names if name != "processed_time"])


@register
def stream_alerts(spark, sf_dir):
    """Runs of alert hours by micro-batches that hold readings of all times. A last reading, far later, ends them."""
    path, checkpoint = workspace.scratch(spark, "alerts"), workspace.scratch(spark, "checkpoint")
    landing = landed(spark, fixture.messages(spark, sf_dir))
    delay = span(spark.read.parquet(landing))

    def drain():
        stream = files.stream_messages(spark, landing, max_files=1)
        run.start(flows.alert_stream(parse.parse(stream), delay), flows.alert_sink(path), checkpoint).awaitTermination()

    drain()
    later = F.col("timestamp") + F.expr("INTERVAL 3650 DAYS")
    landed(spark, fixture.messages(spark, sf_dir).limit(1).withColumn("timestamp", later), mode="append", path=landing)
    drain()
    return spark.read.parquet(path).select("city", "first_hour", "last_hour", "hours", "aqi_max")


@register
def stream_replay(spark, sf_dir):
    """Archived messages, some of them twice, then a live stream that holds all messages; the job stops in between and is
    started again."""
    path, stored, checkpoint = (workspace.scratch(spark, label) for label in ("measurements", "archive", "checkpoint"))
    sent, dimension = fixture.messages(spark, sf_dir), fixture.dimension(spark, sf_dir)
    for owner, part in (("one", F.floor(F.col("offset") / 700) % 3 != 1), ("two", F.col("offset") % 4 == 0)):
        archive.write_archive(sent.where(part), stored, fmt="parquet", owner=owner)
    landing = workspace.scratch(spark, "landing")

    def drain():
        jobs.run_replay_stream(
            spark, stored, lambda _: files.stream_messages(spark, landing, max_files=2), dimension, path, checkpoint,
            fmt="parquet", trigger=None,
        ).awaitTermination()

    for part in (0, 1):
        landed(spark, sent.where(F.col("offset") % 2 == part), mode="append", path=landing)
        drain()
    return jobs.read_measurements(spark, path).select(*RECORD_ID, "city", "aqi", "pm25", "measurement_time")


@register
def stream_metrics(spark, sf_dir):
    """Counts of three micro-batches, as they were observed while the batches were written."""
    path, table, checkpoint, landing = (
        workspace.scratch(spark, label) for label in ("measurements", "metrics", "checkpoint", "landing")
    )
    sent, dimension = fixture.messages_some_broken(spark, sf_dir), fixture.dimension(spark, sf_dir)
    for part in range(LANDED_FILES):
        landed(spark, sent.where(F.col("offset") % LANDED_FILES == part), mode="append", path=landing)
        stream = files.stream_messages(spark, landing)
        jobs.run_realtime(stream, dimension, path, checkpoint, trigger=None, metrics=table).awaitTermination()
    return jobs.read_metrics(spark, table).drop("stream")


# --- dashboards ----------------------------------------------------------------------------------------------

@register
def latest_by_city(spark, sf_dir):
    return insights.latest_by_city(fixture.measurements(spark, sf_dir)).select(
        "city", "measurement_time", "offset", "aqi", "pm25", "pm10", "station_name"
    )


@register
def trend_24h(spark, sf_dir):
    return insights.trend_24h(rollup.hourly(fixture.measurements(spark, sf_dir)))


@register
def weekly_pattern(spark, sf_dir):
    return insights.weekly_pattern(hours_with_counts(spark, sf_dir))


@register
def monthly_pattern(spark, sf_dir):
    return insights.monthly_pattern(hours_with_counts(spark, sf_dir))


@register
def weekday_pattern(spark, sf_dir):
    return insights.weekday_pattern(hours_with_counts(spark, sf_dir))


@register
def level_share(spark, sf_dir):
    return insights.level_share(fixture.classified(spark, sf_dir))


@register
def city_comparison(spark, sf_dir):
    return insights.city_comparison(hours_with_counts(spark, sf_dir), fixture.dimension(spark, sf_dir))


@register
def region_rollup(spark, sf_dir):
    return insights.region_rollup(hours_with_counts(spark, sf_dir), fixture.dimension(spark, sf_dir))


@register
def city_rank(spark, sf_dir):
    return insights.city_rank(rollup.daily(rollup.hourly(fixture.measurements(spark, sf_dir))))


@register
def alert_hours(spark, sf_dir):
    return insights.alert_hours(rollup.hourly(fixture.measurements(spark, sf_dir)))


@register
def alerts(spark, sf_dir):
    return insights.alert_runs(rollup.hourly(fixture.measurements(spark, sf_dir)))


@register
def weather_corr(spark, sf_dir):
    return insights.weather_corr(fixture.measurements(spark, sf_dir))


@register
def aqi_trend_fit(spark, sf_dir):
    return forecast.trend_fit(rollup.hourly(fixture.measurements(spark, sf_dir)), "2024-01-01")


def _forecast_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once: fitting, scoring and forecasting each read them."""
    path = workspace.scratch(spark, "features")
    rows = forecast.features(rollup.hourly(fixture.measurements(spark, sf_dir)))
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@register
def forecast_features(spark, sf_dir):
    """What the model learns from, and the coming hours it is asked for."""
    return forecast.features(rollup.hourly(fixture.measurements(spark, sf_dir)))


# Origins of the backtest begin here, and from the second date on they test what the earlier ones calibrated.
BACKTEST, TESTED = date(2024, 1, 8), date(2024, 1, 20)


def _to_places(rows: DataFrame, places: int = 3) -> DataFrame:
    """Doubles that depend on a fit, to fewer places: two ways of solving it differ beyond."""
    doubles = [field.name for field in rows.schema.fields if isinstance(field.dataType, DoubleType)]
    return rows.withColumns({name: F.round(name, places) for name in doubles})


@register
def aqi_forecast(spark, sf_dir):
    rows = _forecast_features(spark, sf_dir)
    return _to_places(forecast.forecast(rows, forecast.fit(rows)))


@register
def forecast_backtest(spark, sf_dir):
    """Bands by horizon and what they cover of later hours."""
    return _to_places(forecast.backtest(_forecast_features(spark, sf_dir), BACKTEST, TESTED))


@register
def forecast_banded(spark, sf_dir):
    """The forecast with bands from all origins."""
    rows = _forecast_features(spark, sf_dir)
    bands = forecast.conformal_bands(forecast.backtest_errors(rows, BACKTEST))
    return _to_places(forecast.forecast_banded(rows, forecast.fit(rows), bands))


@register
def forecast_importance(spark, sf_dir):
    return forecast.importance(spark, forecast.fit(_forecast_features(spark, sf_dir)))
