"""Hourly, daily and weekly statistics. Every aggregate here has a fixed-width buffer, so Spark hashes and
pre-aggregates each input split before the shuffle: a city with most of the rows sends one row per hour and
split, not its readings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from breathline.functions.clock import hour_start
from breathline.operators.enrich import sized

# Statistics kept per quantity, in column order.
STATISTICS = {
    "aqi": ["avg", "max", "min", "stddev"],
    "pm25": ["avg", "max", "min"],
    "pm10": ["avg", "max", "min"],
    "temperature": ["avg"],
    "humidity": ["avg"],
}

_FUNCTIONS = {"avg": F.avg, "max": F.max, "min": F.min, "stddev": F.stddev_pop}

HOURLY_KEYS = ["city", "hour_start"]
DAILY_KEYS = ["city", "date"]


def hourly_statistics(counts: bool = False) -> list[Column]:
    """Aggregates of one hour. ``counts`` adds the non-null count of each quantity, which an exact mean over
    longer periods needs."""
    kept = [_FUNCTIONS[stat](name).alias(f"{name}_{stat}") for name, stats in STATISTICS.items() for stat in stats]
    kept.append(F.count("*").cast("int").alias("record_count"))
    return kept + ([F.count(name).alias(f"{name}_n") for name in STATISTICS] if counts else [])


def hourly(measurements: DataFrame, counts: bool = False) -> DataFrame:
    return measurements.groupBy("city", hour_start(F.col("measurement_time")).alias("hour_start")).agg(
        *hourly_statistics(counts)
    )


def _coarser(total: str, records: str) -> list[Column]:
    """Means of means, extremes of extremes, sum of counts."""
    kept = [
        _FUNCTIONS[stat](f"{name}_{stat}").alias(f"{name}_{stat}")
        for name, stats in STATISTICS.items() for stat in stats if stat != "stddev"
    ]
    return [*kept, F.sum(records).alias(total)]


def daily(hours: DataFrame) -> DataFrame:
    """Each hour weighs the same, whatever its number of readings."""
    return hours.groupBy("city", F.to_date("hour_start").alias("date")).agg(*_coarser("total_records", "record_count"))


def weekly(days: DataFrame) -> DataFrame:
    """The daily rule once more, by Monday-based week."""
    week = F.date_trunc("week", "date").cast("date").alias("week_start")
    return days.groupBy("city", week).agg(*_coarser("total_records", "total_records"))


def weighted_mean(name: str) -> Column:
    """True mean of a quantity over hours that carry its non-null count."""
    weight = F.col(f"{name}_n")
    total = F.sum(weight)
    return (F.sum(F.col(f"{name}_avg") * weight) / F.when(total > 0, total)).alias(f"{name}_avg")


def daily_weighted(hours: DataFrame) -> DataFrame:
    """Each reading weighs the same. Needs hours with counts."""
    return hours.groupBy("city", F.to_date("hour_start").alias("date")).agg(
        *[weighted_mean(name) for name in STATISTICS], F.sum("record_count").alias("total_records")
    )


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of equally shaped tables, matched by column name."""
    return reduce(DataFrame.unionByName, tables)


def of_cities(rows: DataFrame, cities: DataFrame) -> DataFrame:
    """Union over the cities of a list, where all cities share one table: a single scan."""
    return rows.join(sized(cities.select("city")), ["city"], "left_semi")
