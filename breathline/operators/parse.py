"""From messages to flat measurement rows, and the split into valid and rejected ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from breathline.functions.clock import LOCAL_OFFSET_HOURS, local_time
from breathline.schema import ENVELOPE, MEASUREMENT

CORRUPT = "_corrupt_record"


def _flat(offset_hours: int, processed_time: Column | None, event_time: str) -> list[Column]:
    payload = "data.payload"
    measured = local_time(F.col("timestamp"), offset_hours)
    if event_time == "payload":  # the feed's own local time; the broker's where it gives none
        measured = F.coalesce(F.try_to_timestamp(F.col(f"{payload}.time.s"), F.lit("yyyy-MM-dd HH:mm:ss")), measured)
    fields = {
        "city": F.col("data.city"),
        "aqi": F.col(f"{payload}.aqi"),
        "station_id": F.col(f"{payload}.idx"),
        "dominant_pollutant": F.col(f"{payload}.dominentpol"),
        "pm25": F.col(f"{payload}.iaqi.pm25.v"),
        "pm10": F.col(f"{payload}.iaqi.pm10.v"),
        "temperature": F.col(f"{payload}.iaqi.t.v"),
        "humidity": F.col(f"{payload}.iaqi.h.v"),
        "measurement_time": measured,
        "station_name": F.col(f"{payload}.city.name"),
        # get() yields null on a short or missing array; [] would fail the job in ANSI mode.
        "latitude": F.get(F.col(f"{payload}.city.geo"), F.lit(0)),
        "longitude": F.get(F.col(f"{payload}.city.geo"), F.lit(1)),
        "processed_time": F.current_timestamp() if processed_time is None else processed_time,
    }
    return [fields[name].alias(name) for name in MEASUREMENT.names]


def parse(
    records: DataFrame,
    offset_hours: int = LOCAL_OFFSET_HOURS,
    processed_time: Column | None = None,
    keep: Sequence[str] = (),
    event_time: str = "broker",
) -> DataFrame:
    """Messages to the 13 measurement columns, plus the message columns named in ``keep``. ``event_time`` says
    whose clock dates a reading: the broker's, moved by ``offset_hours``, or the payload's.

    Permissive: text that is no JSON gives a row of nulls, a bad field a null in that field only.
    """
    text = F.col("value").cast("string")
    parsed = records.withColumn("data", F.from_json(text, ENVELOPE))
    return parsed.select(*_flat(offset_hours, processed_time, event_time), *keep)


def parse_checked(
    records: DataFrame,
    offset_hours: int = LOCAL_OFFSET_HOURS,
    processed_time: Column | None = None,
    keep: Sequence[str] = (),
    event_time: str = "broker",
) -> DataFrame:
    """``parse`` with a ``problem`` column: no_city, bad_field, or null for a clean row."""
    schema = StructType([*ENVELOPE, StructField(CORRUPT, StringType())])
    text = F.col("value").cast("string")
    parsed = records.withColumn("data", F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT}))
    problem = F.when(F.col("data.city").isNull(), "no_city").when(F.col(f"data.{CORRUPT}").isNotNull(), "bad_field")
    return parsed.select(*_flat(offset_hours, processed_time, event_time), *keep, problem.alias("problem"))


def is_rejected(strict: bool = False) -> Column:
    """Rows without a city belong nowhere. A single bad field is common in the feed ("-" for no value) and
    only rejects a row in strict mode."""
    problem = F.col("problem")
    return problem.isNotNull() if strict else problem.eqNullSafe("no_city")


def split(checked: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected rows."""
    return checked.where(~is_rejected(strict)), checked.where(is_rejected(strict))
