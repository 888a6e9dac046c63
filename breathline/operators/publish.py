"""From flat readings to keyed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from breathline.functions.names import TOPIC_PREFIX, topic


def envelope() -> Column:
    """The feed's nested message of a flat reading. Missing values leave no field behind."""
    reading = {"pm25": "pm25", "pm10": "pm10", "t": "temperature", "h": "humidity"}
    payload = F.struct(
        F.col("aqi"),
        F.col("station_id").alias("idx"),
        F.col("dominant_pollutant").alias("dominentpol"),
        F.struct(*[F.struct(F.col(name).alias("v")).alias(short) for short, name in reading.items()]).alias("iaqi"),
        F.struct(
            F.col("station_name").alias("name"), F.array("latitude", "longitude").alias("geo")
        ).alias("city"),
    )
    return F.to_json(F.struct(F.col("city"), payload.alias("payload")))


def wrap(city: Column, payload: Column) -> Column:
    """The feed's message around a raw payload: its JSON text is kept as it is, every field of it, and a missing
    or empty payload is null."""
    name = F.substring(F.to_json(F.struct(F.coalesce(city, F.lit("")).alias("c"))), 6, 1 << 30)
    quoted = F.when(city.isNull(), F.lit("null")).otherwise(F.left(name, F.length(name) - 1))
    body = F.when(F.trim(payload) == "", F.lit("null")).otherwise(F.coalesce(payload, F.lit("null")))
    return F.concat(F.lit('{"city":'), quoted, F.lit(',"payload":'), body, F.lit("}"))


def publish(readings: DataFrame, prefix: str = TOPIC_PREFIX, value: Column | None = None) -> DataFrame:
    """Adds the three columns a keyed message needs; messages of one city share key and topic."""
    return readings.select(
        F.col("city").cast("binary").alias("key"),
        (envelope() if value is None else value).cast("binary").alias("value"),
        topic(F.col("city"), prefix).alias("topic"),
        *[name for name in ("partition", "offset", "timestamp") if name in readings.columns],
    )


def write_broker(messages: DataFrame, options: dict[str, str]) -> None:
    """Needs the Kafka connector on the cluster's class path; the broker assigns partition and offset."""
    messages.select("key", "value", "topic").write.format("kafka").options(**options).save()
