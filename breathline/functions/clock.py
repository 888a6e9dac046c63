"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: readings are dated in local time, a fixed offset ahead of the broker's clock.
LOCAL_OFFSET_HOURS = 7


def local_time(broker_time: Column, offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    return broker_time + F.make_dt_interval(hours=F.lit(offset_hours))


def hour_start(time: Column) -> Column:
    return F.date_trunc("hour", time)


def date_parts(time: Column) -> dict[str, Column]:
    """Zero-padded path parts."""
    return {
        "year": F.date_format(time, "yyyy"),
        "month": F.date_format(time, "MM"),
        "day": F.date_format(time, "dd"),
    }
