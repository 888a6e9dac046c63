"""Dashboard queries.

They read the hourly or daily table where those suffice: per city that is one row per hour, however many
readings there are, which bounds every window below by the hours of the history. "Hours with counts" are the
output of ``hourly(..., counts=True)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from breathline import workspace
from breathline.functions.ladders import LEVELS
from breathline.operators.enrich import sized
from breathline.operators.rollup import STATISTICS, weighted_mean

HOUR = 3600


def latest_by_city(measurements: DataFrame, tie: str = "offset") -> DataFrame:
    """The newest reading of each city; the higher ``tie`` wins at the same time.

    The newest time per city takes two columns and a hash aggregate. With it known, the wide columns are only
    read from the time of the most silent city on, and only rows at a newest time are aggregated whole.
    """
    newest = workspace.cut(
        measurements.groupBy(F.col("city").alias("newest_city")).agg(F.max("measurement_time").alias("newest_time")),
        "newest",
    )
    silent_since, untimed = newest.agg(
        F.unix_micros(F.min("newest_time")), F.coalesce(F.bool_or(F.col("newest_time").isNull()), F.lit(False))
    ).first()
    recently = F.col("measurement_time") >= F.timestamp_micros(F.lit(silent_since).cast("bigint"))
    if untimed:  # a city none of whose readings has a time
        recently = F.coalesce(recently, F.lit(False)) | F.col("measurement_time").isNull()
    recent = measurements.where(recently)
    at_newest = F.col("city").eqNullSafe(F.col("newest_city")) & F.col("measurement_time").eqNullSafe(F.col("newest_time"))
    row = F.max_by(F.struct(*measurements.columns), F.col(tie)).alias("row")
    return recent.join(sized(newest), at_newest, "left_semi").groupBy("city").agg(row).select("row.*")


def trend_24h(hours: DataFrame) -> DataFrame:
    """Hourly mean and the mean over that hour and the 23 before it, hours without readings left out."""
    day = Window.partitionBy("city").orderBy(F.col("hour_start").cast("long")).rangeBetween(-23 * HOUR, 0)
    return hours.select("city", "hour_start", "aqi_avg", F.avg("aqi_avg").over(day).alias("aqi_avg_24h"))


def _pattern(hours: DataFrame, *period: Column) -> DataFrame:
    return hours.groupBy("city", *period).agg(
        *[weighted_mean(name) for name in ("aqi", "pm25", "pm10")],
        F.max("aqi_max").alias("aqi_max"),
        F.sum("record_count").alias("records"),
    )


def weekly_pattern(hours: DataFrame) -> DataFrame:
    """Needs hours with counts, as do the two patterns below."""
    return _pattern(hours, F.date_trunc("week", "hour_start").cast("date").alias("week_start"))


def monthly_pattern(hours: DataFrame) -> DataFrame:
    return _pattern(hours, F.date_trunc("month", "hour_start").cast("date").alias("month_start"))


def weekday_pattern(hours: DataFrame) -> DataFrame:
    """By weekday (0 is Monday) and hour of day."""
    return _pattern(hours, F.weekday("hour_start").alias("weekday"), F.hour("hour_start").alias("hour"))


def level_share(classified: DataFrame) -> DataFrame:
    """Share of each pollution level among a city's readings."""
    share = [
        (F.count_if(F.col("pollution_level") == level) / F.count("*")).alias(f"{level.lower()}_share")
        for level in LEVELS
    ]
    return classified.groupBy("city").agg(F.count("*").alias("records"), *share)


def _city_totals(hours: DataFrame) -> DataFrame:
    """One mergeable row per city, so that coarser groups need no second pass over the hours."""
    names = list(STATISTICS)
    return hours.groupBy("city").agg(
        *[F.sum(F.col(f"{name}_avg") * F.col(f"{name}_n")).alias(f"{name}_total") for name in names],
        *[F.sum(f"{name}_n").alias(f"{name}_n") for name in names],
        F.max("aqi_max").alias("aqi_max"),
        F.min("aqi_min").alias("aqi_min"),
        F.sum("record_count").alias("records"),
    )


def _mean(name: str, total: Column, weight: Column) -> Column:
    return (total / F.when(weight > 0, weight)).alias(f"{name}_avg")


def city_comparison(hours: DataFrame, dimension: DataFrame) -> DataFrame:
    """One row per city with its region. Needs hours with counts."""
    known = sized(dimension.select("city", "city_name", "region"))
    return _city_totals(hours).join(known, ["city"], "left").select(
        "city", "city_name", "region",
        *[_mean(name, F.col(f"{name}_total"), F.col(f"{name}_n")) for name in STATISTICS],
        "aqi_max", "aqi_min", "records",
    )


def region_rollup(hours: DataFrame, dimension: DataFrame) -> DataFrame:
    """Cities, regions and the whole (``depth`` 0, 1, 3). Needs hours with counts."""
    located = _city_totals(hours).join(sized(dimension.select("city", "region")), ["city"], "left")
    return located.rollup("region", "city").agg(
        F.grouping_id().cast("int").alias("depth"),
        *[_mean(name, F.sum(f"{name}_total"), F.sum(f"{name}_n")) for name in ("aqi", "pm25", "pm10")],
        F.max("aqi_max").alias("aqi_max"),
        F.sum("records").alias("records"),
    )


def city_rank(days: DataFrame) -> DataFrame:
    """Rank of each city among the cities of a date, from the best and from the worst air."""
    best = Window.partitionBy("date").orderBy(F.col("aqi_avg").asc())
    worst = Window.partitionBy("date").orderBy(F.col("aqi_avg").desc())
    measured = days.where(F.col("aqi_avg").isNotNull())
    return measured.select(
        "date", "city", "aqi_avg", F.rank().over(best).alias("best_rank"), F.rank().over(worst).alias("worst_rank")
    )


def alert_hours(hours: DataFrame, threshold: int = 200) -> DataFrame:
    return hours.where(F.col("aqi_max") > threshold).select("city", "hour_start", "aqi_max", "aqi_avg")


def alert_runs(hours: DataFrame, threshold: int = 200) -> DataFrame:
    """Unbroken runs of alert hours. Within a run, hour minus position is constant."""
    position = F.row_number().over(Window.partitionBy("city").orderBy("hour_start"))
    run = F.col("hour_start").cast("long") - position * HOUR
    return alert_hours(hours, threshold).withColumn("run", run).groupBy("city", "run").agg(
        F.min("hour_start").alias("first_hour"),
        F.max("hour_start").alias("last_hour"),
        F.count("*").cast("int").alias("hours"),
        F.max("aqi_max").alias("aqi_max"),
    ).drop("run")


def weather_corr(measurements: DataFrame) -> DataFrame:
    pairs = [(air, weather) for air in ("aqi", "pm25", "pm10") for weather in ("temperature", "humidity")]
    return measurements.groupBy("city").agg(
        *[F.corr(air, weather).alias(f"{air}_{weather}_corr") for air, weather in pairs]
    )
