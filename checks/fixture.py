"""The test tables seen as air-quality data (mapping in FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from breathline.functions.ladders import HEALTH_STEPS, THRESHOLD_COLUMNS
from breathline.functions.names import TOPIC_PREFIX, topic
from breathline.functions.clock import local_time
from breathline.operators.enrich import classify
from breathline.operators.publish import envelope, publish
from breathline.schema import DIMENSION, RECORD

# Region whose cities the dimension does not list, so that the left join has rows without a match.
UNLISTED_REGION = "EUROPE"

# Events of this type stand for a transmission that broke off.
BROKEN_TYPE = "error"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat readings with the message columns that the broker would add."""
    events = (
        table(spark, sf_dir, "events")
        .join(table(spark, sf_dir, "customer"), F.col("user_id") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )

    def unless_every(nth: int, value):
        return F.when(F.col("event_id") % nth != 0, value)

    k = F.get_json_object("props", "$.k").try_cast("double")
    city = F.lower("n_name")
    return events.select(
        city.alias("city"),
        unless_every(97, F.floor("value").cast("int")).alias("aqi"),
        F.col("user_id").try_cast("int").alias("station_id"),
        F.col("event_type").alias("dominant_pollutant"),
        unless_every(89, F.col("value")).alias("pm25"),
        unless_every(83, unless_every(89, 2 * k)).alias("pm10"),
        (F.col("value") / 10).alias("temperature"),
        k.alias("humidity"),
        F.col("c_name").alias("station_name"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        F.col("n_regionkey").cast("double").alias("longitude"),
        topic(city, TOPIC_PREFIX).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(readings(spark, sf_dir)).select(*RECORD.names)


def messages_some_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the text of broken transmissions cut in half."""
    text = envelope()
    half = F.substring(text, F.lit(1), F.length(text).cast("int") / 2)
    sent = F.when(F.col("dominant_pollutant") == BROKEN_TYPE, half).otherwise(text)
    return publish(readings(spark, sf_dir), value=sent).select(*RECORD.names)


def messages_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with a fault of its own kind in five of every eight messages."""
    text, number = envelope(), F.col("offset") % 8
    payload = F.get_json_object(text, "$.payload")
    sent = (
        F.when(number == 0, F.substring(text, F.lit(1), F.length(text).cast("int") / 2))
        .when(number == 1, F.concat(F.lit("["), text, F.lit("]")))
        .when(number == 2, F.concat(F.lit('{"payload":'), payload, F.lit("}")))
        .when(number == 3, F.concat(F.lit('{"city":"'), F.col("city"), F.lit('","payload":"Unknown station"}')))
        .when(number == 4, F.replace(F.replace(text, F.lit('"idx":'), F.lit('"idx":"-","was":')), F.lit('"geo":['), F.lit('"geo":0,"at":[')))
        .otherwise(text)
    )
    return publish(readings(spark, sf_dir), value=sent).select(*RECORD.names)


def dimension_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension from the year's second day on, and with bounds of the cities' own from a later day, which differs by
    city."""
    bounded, days = dimension_own_bounds(spark, sf_dir), (F.col("population") / 1000).cast("int")
    return dimension(spark, sf_dir).withColumn("valid_from", F.lit("2024-01-02").cast("timestamp")).unionByName(
        bounded.withColumn("valid_from", F.date_add(F.lit("2024-01-02").cast("date"), days).cast("timestamp"))
    )


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as the measurement table holds them, without the JSON round trip."""
    return readings(spark, sf_dir).withColumn("measurement_time", local_time(F.col("timestamp")))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(measurements(spark, sf_dir))


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    fields = {
        "city": F.lower("n_name"),
        "city_name": F.col("n_name"),
        "country": F.lit("Testland"),
        "region": F.col("r_name"),
        "population": (1000 * (F.col("n_nationkey") + 1)).cast("bigint"),
        "timezone": F.lit("Asia/Bangkok"),
        **{name: F.lit(bound) for name, (bound, _) in zip(THRESHOLD_COLUMNS, HEALTH_STEPS)},
    }
    return located.where(F.col("r_name") != UNLISTED_REGION).select(*[fields[name].alias(name) for name in DIMENSION.names])


def dimension_own_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds that differ by city; one of them is missing for the cities of one region."""
    step = F.col("population") / 1000
    bounds = {
        name: (F.col(name) + step).cast("int") for name in THRESHOLD_COLUMNS
    }
    bounds["aqi_threshold_moderate"] = F.when(F.col("region") != "ASIA", bounds["aqi_threshold_moderate"])
    return dimension(spark, sf_dir).withColumns(bounds)
