"""Fixed schemas and column orders."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BinaryType, DataType, DateType, DoubleType, IntegerType, LongType, StringType, StructField,
    StructType, TimestampType,
)

TEXT, INT, LONG, DOUBLE, TIME, DATE = StringType(), IntegerType(), LongType(), DoubleType(), TimestampType(), DateType()


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


# One message of the stream, as the broker connector delivers it.
RECORD = _struct(key=BinaryType(), value=BinaryType(), topic=TEXT, partition=INT, offset=LONG, timestamp=TIME)

# Identity of a message: a replay carries the same three values again.
RECORD_ID = ["topic", "partition", "offset"]

_VALUE = _struct(v=DOUBLE)

# Field names and spelling of the feed. time.v is an epoch and may exceed 32 bits.
ENVELOPE = _struct(
    city=TEXT,
    payload=_struct(
        aqi=INT,
        idx=INT,
        dominentpol=TEXT,
        iaqi=_struct(pm25=_VALUE, pm10=_VALUE, t=_VALUE, h=_VALUE),
        time=_struct(s=TEXT, tz=TEXT, v=LONG),
        city=_struct(name=TEXT, geo=ArrayType(DOUBLE)),
    ),
)

MEASUREMENT = _struct(
    city=TEXT, aqi=INT, station_id=INT, dominant_pollutant=TEXT, pm25=DOUBLE, pm10=DOUBLE, temperature=DOUBLE,
    humidity=DOUBLE, measurement_time=TIME, station_name=TEXT, latitude=DOUBLE, longitude=DOUBLE, processed_time=TIME,
)

CLASSES = _struct(health_status=TEXT, pollution_level=TEXT)

DIMENSION = _struct(
    city=TEXT, city_name=TEXT, country=TEXT, region=TEXT, population=LONG, timezone=TEXT,
    aqi_threshold_good=INT, aqi_threshold_moderate=INT, aqi_threshold_unhealthy_sensitive=INT,
    aqi_threshold_unhealthy=INT, aqi_threshold_very_unhealthy=INT,
)

# The measurement table: flat reading, its two classes, the city's dimension row, the message's id, and the
# folders it is stored in.
STORED = StructType([
    *MEASUREMENT, *CLASSES, *DIMENSION[1:], *_struct(topic=TEXT, partition=INT, offset=LONG),
    *_struct(processed_date=DATE, stream=TEXT, batch_id=LONG),
])

# One row for each micro-batch of the realtime job.
METRICS = _struct(
    rows=LONG, without_city=LONG, without_index=LONG, unlisted=LONG, first_time=TIME, last_time=TIME, stream=TEXT, batch_id=LONG
)

HOURLY = _struct(
    city=TEXT, hour_start=TIME, aqi_avg=DOUBLE, aqi_max=INT, aqi_min=INT, aqi_stddev=DOUBLE,
    pm25_avg=DOUBLE, pm25_max=DOUBLE, pm25_min=DOUBLE, pm10_avg=DOUBLE, pm10_max=DOUBLE, pm10_min=DOUBLE,
    temperature_avg=DOUBLE, humidity_avg=DOUBLE, record_count=INT,
)

DAILY = _struct(
    city=TEXT, date=DATE, aqi_avg=DOUBLE, aqi_max=INT, aqi_min=INT,
    pm25_avg=DOUBLE, pm25_max=DOUBLE, pm25_min=DOUBLE, pm10_avg=DOUBLE, pm10_max=DOUBLE, pm10_min=DOUBLE,
    temperature_avg=DOUBLE, humidity_avg=DOUBLE, total_records=LONG,
)

ARCHIVE = _struct(
    json_data=TEXT, kafka_timestamp=TIME, topic=TEXT, partition=INT, kafka_offset=LONG,
    city=TEXT, year=INT, month=INT, day=INT,
)

# The archive with the folders that its writers own; parts of dates are texts, as folders spell them with zeros.
ARCHIVE_STORED = StructType([
    *ARCHIVE[:5], *_struct(city=TEXT, year=TEXT, month=TEXT, day=TEXT, stream=TEXT, batch_id=LONG)
])
