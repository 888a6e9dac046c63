"""Index forecasts from the hourly table."""

from __future__ import annotations

from datetime import date
from math import pi

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from breathline.operators.enrich import sized

HOUR = 3600
AHEAD = 24
FEATURES = ["same_hour_yesterday", "day_mean", "hour_sin", "hour_cos"]


def trend_fit(hours: DataFrame, origin: str) -> DataFrame:
    """Straight line per city: change of the hourly mean per hour, and its value at ``origin``."""
    x = (F.col("hour_start").cast("long") - F.lit(origin).cast("timestamp").cast("long")) / HOUR
    y = F.col("aqi_avg")
    return hours.groupBy("city").agg(
        F.regr_count(y, x).alias("hours"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )


def features(hours: DataFrame, ahead: int = AHEAD) -> DataFrame:
    """Known hours (``known`` true) and the next ``ahead`` hours of each city, with features that lie at
    least ``ahead`` hours back, so that the same model serves every hour of the forecast. Known hours with no
    history are left out, as nothing can be learnt from them; every coming hour is there."""
    seen = hours.select("city", "hour_start", "aqi_avg", F.lit(True).alias("known"))
    step = F.expr("INTERVAL 1 HOUR")
    last = seen.where(F.col("aqi_avg").isNotNull()).groupBy("city").agg(F.max("hour_start").alias("last"))
    coming = last.select(
        "city",
        F.explode(F.sequence(F.col("last") + step, F.col("last") + step * ahead, step)).alias("hour_start"),
        F.lit(None).cast("double").alias("aqi_avg"),
        F.lit(False).alias("known"),
    )
    by_hour = Window.partitionBy("city").orderBy(F.col("hour_start").cast("long"))
    shift = ahead * HOUR
    yesterday = F.max("aqi_avg").over(by_hour.rangeBetween(-shift, -shift))
    day_mean = F.avg("aqi_avg").over(by_hour.rangeBetween(-shift - 23 * HOUR, -shift))
    past_mean = F.avg("aqi_avg").over(by_hour.rangeBetween(Window.unboundedPreceding, -shift))
    angle = F.hour("hour_start") * (2 * pi / 24)
    return (
        seen.unionByName(coming)
        .select("*", yesterday.alias("yesterday"), day_mean.alias("recent"), past_mean.alias("past"),
                F.avg("aqi_avg").over(Window.partitionBy("city")).alias("whole"))
        # A city whose history is shorter than ``ahead`` has nothing that far back for its last hours: its mean.
        .withColumn("day_mean", F.coalesce("recent", "past", F.when(~F.col("known"), F.col("whole"))))
        .withColumn("same_hour_yesterday", F.coalesce("yesterday", "day_mean"))
        .select("city", "hour_start", "aqi_avg", "known", "same_hour_yesterday", "day_mean",
                F.sin(angle).alias("hour_sin"), F.cos(angle).alias("hour_cos"))
        .where(F.col("day_mean").isNotNull() | ~F.col("known"))
    )


def _vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def fit(rows: DataFrame) -> LinearRegressionModel:
    """One least-squares pass over all known hours."""
    known = _vectors(rows.where(F.col("known") & F.col("aqi_avg").isNotNull()))
    return LinearRegression(featuresCol="features", labelCol="aqi_avg", solver="normal").fit(known)


def forecast(rows: DataFrame, model: LinearRegressionModel) -> DataFrame:
    """Expected index of each coming hour with a 95 % band."""
    band = 1.96 * model.summary.rootMeanSquaredError
    expected = F.col("prediction")
    return model.transform(_vectors(rows.where(~F.col("known")))).select(
        "city", "hour_start", expected.alias("aqi_expected"),
        (expected - band).alias("aqi_low"), (expected + band).alias("aqi_high"),
    )


def importance(spark: SparkSession, model: LinearRegressionModel) -> DataFrame:
    """Weight of each feature."""
    weights = [(name, float(weight)) for name, weight in zip(FEATURES, model.coefficients.toArray())]
    return spark.createDataFrame([*weights, ("intercept", float(model.intercept))], "feature STRING, weight DOUBLE")


# Errors are counted in steps of this share of an index point.
STEPS = 1000


def _regressors() -> list:
    return [F.lit(1.0), *[F.col(name) for name in FEATURES]]


def normal_sums(rows: DataFrame, *keys: str) -> DataFrame:
    """Per key the sums that least squares needs: ``s<i>_<j>`` of the products of the regressors (the intercept first),
    and in its last column of those with the index. Sums of disjoint sets of rows add up."""
    columns = [*_regressors(), F.col("aqi_avg")]
    known = rows.where(F.col("known") & F.col("aqi_avg").isNotNull())
    return known.groupBy(*keys).agg(*[
        F.sum(columns[i] * columns[j]).alias(f"s{i}_{j}")
        for i in range(len(FEATURES) + 1) for j in range(i, len(columns))
    ])


def solve(sums: DataFrame, *keys: str) -> DataFrame:
    """Weights ``w0``, ``w1``, ... of each row of ``normal_sums``: the matrix as an array of rows, reduced column by column.
    Sums that do not determine the weights give nulls."""
    count = len(FEATURES) + 1
    matrix = F.array(*[
        F.array(*[F.col(f"s{min(i, j)}_{max(i, j)}") for j in range(count + 1)]) for i in range(count)
    ])

    def reduced(rows, k):
        pivot = F.transform(F.get(rows, k), lambda cell: F.try_divide(cell, F.get(F.get(rows, k), k)))
        return F.transform(rows, lambda row, i: F.when(i == k, pivot).otherwise(
            F.zip_with(row, pivot, lambda cell, share: cell - F.get(row, k) * share)
        ))

    solved = sums.select(*keys, F.aggregate(F.sequence(F.lit(0), F.lit(count - 1)), matrix, reduced).alias("rows"))
    return solved.select(*keys, *[F.get(F.get("rows", F.lit(i)), F.lit(count)).alias(f"w{i}") for i in range(count)])


def backtest_errors(rows: DataFrame, first: date) -> DataFrame:
    """origin, horizon, city, hour_start, error: every known hour from ``first`` on, forecast at the midnight before it
    (the origin) by a model that has seen the hours before the origin alone.

    Readings are summed by date once; the sums before each origin are running totals over one row a date. Each hour is
    then scored by its origin's weights. Hours whose origin has too little history for a model have no row.
    """
    dated = rows.where(F.col("known") & F.col("aqi_avg").isNotNull()).withColumn("origin", F.to_date("hour_start"))
    sums = normal_sums(dated, "origin")
    before = Window.orderBy("origin").rowsBetween(Window.unboundedPreceding, -1)
    running = sums.select("origin", *[F.sum(name).over(before).alias(name) for name in sums.columns if name != "origin"])
    weights = solve(running.where(F.col("origin") >= F.lit(first)), "origin")
    expected = sum((F.col(f"w{i}") * one for i, one in enumerate(_regressors())), F.lit(0.0))
    scored = dated.where(F.col("origin") >= F.lit(first)).join(sized(weights), "origin")
    return scored.select(
        "origin", (F.hour("hour_start") + 1).alias("horizon"), "city", "hour_start",
        F.abs(F.col("aqi_avg") - expected).alias("error"),
    ).where(F.col("error").isNotNull())


def conformal_bands(errors: DataFrame, percent: int = 95) -> DataFrame:
    """Per horizon ``calibrated`` (its errors) and ``band``: the least width, in steps of 0.001, that holds
    ``percent`` of 100 new errors of the same kind, whatever their distribution (split conformal). Too few errors
    for that give a null band, which means no bound.

    Errors are counted by their step first, so the running totals are over distinct widths, not over readings.
    """
    counted = errors.groupBy("horizon", F.ceil(F.col("error") * STEPS).alias("step")).agg(F.count("*").alias("errors"))
    by_step = Window.partitionBy("horizon").orderBy("step")
    running = counted.select(
        "horizon", "step", F.sum("errors").over(by_step).alias("reached"),
        F.sum("errors").over(Window.partitionBy("horizon")).alias("calibrated"),
    )
    needed = F.ceil((F.col("calibrated") + 1) * percent / 100)
    enough = F.when(F.col("reached") >= needed, F.col("step"))
    return running.groupBy("horizon").agg(
        F.max("calibrated").alias("calibrated"), (F.min(enough) / STEPS).alias("band")
    )


def backtest(rows: DataFrame, first: date, split: date, percent: int = 95) -> DataFrame:
    """Per horizon: the band calibrated on origins before ``split``, and how many hours of the origins from ``split``
    on it covers (``tested``, ``covered``), with their mean error. Horizons without calibrated errors are left out."""
    errors = backtest_errors(rows, first)
    bands = conformal_bands(errors.where(F.col("origin") < F.lit(split)), percent)
    return errors.where(F.col("origin") >= F.lit(split)).join(F.broadcast(bands), "horizon").groupBy(
        "horizon", "calibrated", "band"
    ).agg(
        F.count("*").alias("tested"), F.count_if(F.coalesce(F.col("error") <= F.col("band"), F.lit(True))).alias("covered"),
        F.avg("error").alias("mean_error"),
    )


def forecast_banded(rows: DataFrame, model: LinearRegressionModel, bands: DataFrame) -> DataFrame:
    """``forecast`` with the band of each hour's horizon, one row of ``bands`` for each of the hours of a day, in place of
    one band from the fit's own errors. Hours of a horizon without a band have no bounds."""
    first = F.min("hour_start").over(Window.partitionBy("city"))
    ahead = (F.unix_timestamp("hour_start") - F.unix_timestamp(first)) / HOUR + 1
    expected = forecast(rows, model).select("city", "hour_start", "aqi_expected", ahead.cast("int").alias("horizon"))
    return expected.join(F.broadcast(bands.select("horizon", "band")), "horizon", "left").select(
        "city", "hour_start", "horizon", "aqi_expected",
        (F.col("aqi_expected") - F.col("band")).alias("aqi_low"), (F.col("aqi_expected") + F.col("band")).alias("aqi_high"),
    )
