"""The streaming jobs as compositions of the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from breathline.functions.clock import LOCAL_OFFSET_HOURS, hour_start
from breathline.operators.archive import write_archive
from breathline.operators.enrich import classify, enrich_city
from breathline.operators.moments import partial_moments
from breathline.operators.parse import parse
from breathline.operators.replace import replace_by_key
from breathline.operators.rollup import HOURLY_KEYS, hourly_statistics
from breathline.schema import HOURLY, METRICS, RECORD_ID
from breathline.sinks.tables import OWNER, append_batch, owned, stream_id, write_partitioned
from breathline.streaming.run import Sink


def realtime(
    records: DataFrame,
    dimension: DataFrame,
    offset_hours: int = LOCAL_OFFSET_HOURS,
    processed_time: Column | None = None,
    event_time: str = "broker",
) -> DataFrame:
    """Messages to enriched rows, on a stream or on a table. Row by row but for the small dimension, so a
    hot city costs no more than its share of the input splits."""
    flat = parse(records, offset_hours, processed_time, keep=RECORD_ID, event_time=event_time)
    return enrich_city(classify(flat), dimension).withColumn("processed_date", F.to_date("processed_time"))


def measurement_sink(
    path: str, on_count: Callable[[int, int], None] | None = None, name: str | None = None, owner: str | None = None
) -> Sink:
    """Rows of a batch were all processed at one time, so tasks write one file each, without a shuffle."""
    return append_batch(path, ["processed_date"], ["city", "measurement_time"], on_count, name, owner)


def metered(write: Sink, path: str) -> Sink:
    """``write``, and a row of counts for the batch in the table at ``path``: its rows, those without a city (rejected),
    without an index, of a city that the dimension does not list, and the span of its times. They are observed while
    the batch is written, not counted again; a repeated batch replaces its row, and an empty one has its row too."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"metrics_{batch_id}")
        city, time = F.col("city"), F.col("measurement_time")
        counts = {
            "rows": F.count("*"), "without_city": F.count_if(city.isNull()), "without_index": F.count_if(F.col("aqi").isNull()),
            "unlisted": F.count_if(city.isNotNull() & F.col("city_name").isNull()),
            # As numbers, which reach the driver and return without a time zone in between.
            "first_time": F.unix_micros(F.min(time)), "last_time": F.unix_micros(F.max(time)),
        }
        # Spark may leave an empty batch's observation out with its plan.
        empty = batch.isEmpty()
        write(batch.observe(seen, *[made.alias(name) for name, made in counts.items()]), batch_id)
        said = {name: None if name.endswith("time") else 0 for name in counts} if empty else seen.get
        found = {name: F.lit(said[name]).cast("bigint") for name in counts}
        found.update({name: F.timestamp_micros(found[name]) for name in ("first_time", "last_time")})
        row = batch.sparkSession.range(1).select(*[found[name].alias(name) for name in METRICS.names if name in found])
        write_partitioned(
            owned(row, batch_id, stream_id(batch)), path, OWNER, [], mode="overwrite", dynamic=True, cluster=False
        )

    return sink


def archive_sink(path: str, fmt: str = "json") -> Sink:
    """A batch writes its own folders, so running it again after a failure leaves no second copy. Rows are
    gathered by city and date first: a backlog holds many dates, and every task would open a file for each."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_archive(batch, path, fmt, batch_id)

    return write


def hourly_stream(measurements: DataFrame, delay: str) -> DataFrame:
    """Statistics of the hours that changed. State is one row per city and hour within ``delay``; a reading
    that arrives later than that is left to the batch job, which recomputes its hour from the table."""
    hour = F.window("measurement_time", "1 hour")
    return (
        measurements.withWatermark("measurement_time", delay)
        .groupBy("city", hour)
        .agg(*hourly_statistics())
        .select("city", F.col("window.start").alias("hour_start"), *HOURLY.names[2:])
    )


def hourly_sink(spark: SparkSession, path: str) -> Sink:
    """Replaces the changed hours, so a repeated batch changes nothing. The table is rewritten in ``spark``: the
    session of a stateful stream has adaptive execution off and one task per state partition."""

    def write(batch: DataFrame, batch_id: int) -> None:
        dated = batch.withColumn("date", F.to_date("hour_start"))
        replace_by_key(spark, path, dated, HOURLY_KEYS, "date", HOURLY_KEYS)

    return write


def moments_sink(path: str, owner: str | None = None) -> Sink:
    """Appends the moments of a batch's readings by city and hour. A batch owns its folders, so repeating it adds
    nothing; a reading that comes late is one more row for its hour."""
    append = append_batch(path, ["date"], HOURLY_KEYS, owner=owner)

    def write(batch: DataFrame, batch_id: int) -> None:
        append(partial_moments(batch).withColumn("date", F.to_date("hour_start")), batch_id)

    return write


# Fixed value: an index above this is an alert.
ALERT_INDEX = 200

# Hours that follow each other are less apart than this, others more.
SESSION = "61 minutes"


def alert_stream(measurements: DataFrame, delay: str, threshold: int = ALERT_INDEX) -> DataFrame:
    """Unbroken runs of hours with an index above ``threshold``, each once no reading can join it any more. State is one
    row per open run. All readings move the watermark, also those that are no alert: the condition names the time,
    as Spark would else move it below the watermark."""
    hours = measurements.select("city", "aqi", hour_start(F.col("measurement_time")).alias("hour_start"))
    high = F.when(F.col("hour_start").isNotNull(), F.col("aqi") > threshold)
    runs = hours.withWatermark("hour_start", delay).where(high).groupBy(
        "city", F.session_window("hour_start", SESSION).alias("run")
    ).agg(F.max("aqi").alias("aqi_max"))
    last = F.col("run.end") - F.expr(f"INTERVAL {SESSION}")
    count = (F.unix_timestamp(last) - F.unix_timestamp("run.start")) / 3600 + 1
    return runs.select(
        "city", F.col("run.start").alias("first_hour"), last.alias("last_hour"), count.cast("int").alias("hours"), "aqi_max"
    )


def alert_sink(path: str) -> Sink:
    """Appends the runs that ended, by the date they began on."""
    append = append_batch(path, ["date"], ["city", "first_hour"])

    def write(batch: DataFrame, batch_id: int) -> None:
        append(batch.withColumn("date", F.to_date("first_hour")), batch_id)

    return write
