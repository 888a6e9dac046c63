"""The roll-ups as SQL text over named views, for users who work in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from breathline.operators.rollup import STATISTICS

_NAMES = {"avg": "avg", "max": "max", "min": "min", "stddev": "stddev_pop"}


def _list(of: Callable[[str, str], str], skip: str = "") -> str:
    """Select list over all statistics; ``of`` names the input column of one."""
    return ", ".join(
        f"{_NAMES[stat]}({of(name, stat)}) AS {name}_{stat}"
        for name, stats in STATISTICS.items() for stat in stats if stat != skip
    )


def hourly_text(view: str) -> str:
    return f"""
        SELECT city, date_trunc('HOUR', measurement_time) AS hour_start, {_list(lambda name, stat: name)},
               CAST(count(*) AS INT) AS record_count
        FROM {view} GROUP BY city, hour_start"""


def daily_text(view: str) -> str:
    return f"""
        SELECT city, to_date(hour_start) AS date, {_list(lambda name, stat: f"{name}_{stat}", skip="stddev")},
               sum(record_count) AS total_records
        FROM {view} GROUP BY city, date"""


def over_view(spark: SparkSession, view: str, rows: DataFrame, query: Callable[[str], str]) -> DataFrame:
    """Runs a query over a view that exists only while the query is analysed."""
    rows.createOrReplaceTempView(view)
    try:
        return spark.sql(query(view))
    finally:
        spark.catalog.dropTempView(view)


def hourly_sql(spark: SparkSession, measurements: DataFrame, view: str = "measurements") -> DataFrame:
    return over_view(spark, view, measurements, hourly_text)


def daily_sql(spark: SparkSession, hours: DataFrame, view: str = "hours") -> DataFrame:
    return over_view(spark, view, hours, daily_text)
