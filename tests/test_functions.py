from datetime import datetime

import pytest
from pyspark.sql import functions as F

from breathline.functions import clock, ladders, names
from breathline.schema import RECORD
from breathline.sources.broker import Security, broker_options
from breathline.sources import jdbc
from breathline.sources.jdbc import append_options, time_slices


def labels(spark, schema, values, column):
    rows = spark.createDataFrame([(number, *value) for number, value in enumerate(values)], f"n INT, {schema}")
    return [row[0] for row in rows.orderBy("n").select(column).collect()]


def test_health_status_bounds(spark):
    cases = {
        None: "Unknown", -1: "Good", 0: "Good", 50: "Good", 51: "Moderate", 100: "Moderate",
        101: "Unhealthy for Sensitive", 150: "Unhealthy for Sensitive", 151: "Unhealthy", 200: "Unhealthy",
        201: "Very Unhealthy", 300: "Very Unhealthy", 301: "Hazardous",
    }
    got = labels(spark, "aqi INT", [(value,) for value in cases], ladders.health_status(F.col("aqi")))
    assert got == list(cases.values())


@pytest.mark.parametrize("pm25, pm10, expected", [
    (None, None, "Unknown"), (0.0, None, "Low"), (None, 49.9, "Low"), (49.9, 50.0, "Medium"), (99.9, 0.0, "Medium"),
    (100.0, None, "High"), (149.9, 3.0, "High"), (150.0, 1.0, "Severe"), (-5.0, None, "Low"), (-5.0, -3.0, "Low"),
    (float("nan"), 10.0, "Low"), (10.0, float("nan"), "Low"), (float("nan"), None, "Unknown"),
])
def test_pollution_level(spark, pm25, pm10, expected):
    column = ladders.pollution_level(F.col("pm25"), F.col("pm10"))
    assert labels(spark, "pm25 DOUBLE, pm10 DOUBLE", [(pm25, pm10)], column) == [expected]


def test_city_bounds_fall_back_one_by_one(spark):
    schema = "aqi INT, " + ", ".join(f"{name} INT" for name in ladders.THRESHOLD_COLUMNS)
    values = [(60, 70, 100, 150, 200, 300), (60, None, 100, 150, 200, 300), (110, 70, None, 150, 200, 300),
              (None, 1, 2, 3, 4, 5), (6, 1, 2, 3, 4, 5), (301, None, None, None, None, None)]
    got = labels(spark, schema, values, ladders.health_status_by_city(F.col("aqi")))
    assert got == ["Good", "Moderate", "Unhealthy for Sensitive", "Unknown", "Hazardous", "Hazardous"]


def test_local_time_and_parts(spark):
    time = F.lit(datetime(2024, 2, 29, 18, 30))
    row = spark.range(1).select(
        clock.local_time(time).alias("local"), clock.local_time(time, -3).alias("west"),
        clock.hour_start(time).alias("hour"), *[part.alias(name) for name, part in clock.date_parts(time).items()],
    ).first()
    assert tuple(row) == (
        datetime(2024, 3, 1, 1, 30), datetime(2024, 2, 29, 15, 30), datetime(2024, 2, 29, 18), "2024", "02", "29"
    )


def test_names(spark):
    cities = ["cantho", "nhatrang", "vungtau", "hanoi", None]
    assert labels(spark, "city STRING", [(city,) for city in cities], names.feed_slug(F.col("city"))) == [
        "can-tho", "nha-trang", "vung-tau", "hanoi", None
    ]
    rows = spark.createDataFrame([(b"hue", None, "raw.airquality.x"), (None, None, "raw.airquality.hue")],
                                 "key BINARY, value BINARY, topic STRING")
    assert [row[0] for row in rows.select(names.city_of(F.col("key"), F.col("topic"))).collect()] == ["hue", "hue"]


def test_broker_options():
    plain = broker_options("host:1", cities=["hanoi", "hue"])
    assert plain == {
        "kafka.bootstrap.servers": "host:1", "startingOffsets": "earliest",
        "subscribe": "raw.airquality.hanoi,raw.airquality.hue",
    }
    assert broker_options("host:1")["subscribePattern"] == r"raw\.airquality\..+"
    secured = broker_options("host:1", security=Security("SASL_SSL", "PLAIN", "me", 'a"b'), min_partitions=400)
    assert secured["kafka.security.protocol"] == "SASL_SSL" and secured["minPartitions"] == "400"
    assert secured["kafka.sasl.jaas.config"].endswith('required username="me" password="a\\"b";')


def test_time_slices_cover_each_row_once(spark):
    days = [datetime(2024, 1, day) for day in (3, 1, 2, 2)]
    times = [None, *[datetime(2024, 1, 1 + hour // 24, hour % 24) for hour in range(-0, 96)], datetime(2023, 5, 5)]
    rows = spark.createDataFrame([(time,) for time in times], "t TIMESTAMP")
    slices = time_slices("t", days)
    assert len(slices) == 4
    hits = sum((F.when(F.expr(text), 1).otherwise(0) for text in slices), F.lit(0))
    assert {row[0] for row in rows.select(hits).collect()} == {1}
    assert time_slices("t", []) == ["1 = 1"]


def test_append_options():
    assert append_options(8) == {"numPartitions": "8", "batchsize": "10000"}
    assert append_options(8, isolation="NONE") == {**append_options(8), "isolationLevel": "NONE"}


class Calls:
    """Stands for a session or a frame and notes its JDBC calls; no database runs here."""

    def __init__(self):
        self.made = []
        self.read = self.write = self

    def jdbc(self, *given, **named):
        self.made.append((given, named))


def test_jdbc_reads_in_slices_and_appends_batches():
    session = Calls()
    jdbc.read_table(session, "jdbc:x", "m", {"user": "u"}, "t", [datetime(2024, 1, 1)])
    assert session.made == [(("jdbc:x", "m"), {
        "predicates": ["t < TIMESTAMP '2024-01-01 00:00:00' OR t IS NULL", "t >= TIMESTAMP '2024-01-01 00:00:00'"],
        "properties": {"user": "u"},
    })]
    write = jdbc.append_batch("jdbc:x", "m", {"user": "u"}, connections=4)
    full = Calls()
    write(full, 1)
    assert full.made == [(("jdbc:x", "m"), {"mode": "append", "properties": {"user": "u", **append_options(4)}})]


def test_record_columns():
    assert RECORD.names == ["key", "value", "topic", "partition", "offset", "timestamp"]
