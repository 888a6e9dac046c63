import math
import random
from datetime import timedelta

import numpy as np
import pytest
from rows import at, rows_of
from pyspark.sql import functions as F

from breathline.operators import rollup
from breathline.plans import forecast, insights
from breathline.schema import DIMENSION, HOURLY

START = at("2024-01-01 00:00:00")


def hours_of(spark, rows):
    """Hours from (city, hour number, aqi or None)."""
    made = []
    for city, hour, aqi in rows:
        value = {"city": city, "hour_start": START + timedelta(hours=hour), "record_count": 2}
        if aqi is not None:
            value.update(aqi_avg=float(aqi), aqi_max=int(aqi), aqi_min=int(aqi))
        made.append(tuple(value.get(name) for name in HOURLY.names))
    return spark.createDataFrame(made, HOURLY)


def test_latest_breaks_ties_and_keeps_silent_cities(spark):
    rows = spark.createDataFrame([
        ("a", START, 1, 10), ("a", START + timedelta(hours=1), 2, 20), ("a", START + timedelta(hours=1), 3, 30),
        ("silent", START - timedelta(days=300), 4, 40), (None, START, 5, 50), ("a", START, 9, 60),
    ], "city STRING, measurement_time TIMESTAMP, offset BIGINT, aqi INT")
    assert rows_of(insights.latest_by_city(rows), "city", "offset", "aqi") == [
        ("a", 3, 30), ("silent", 4, 40), (None, 5, 50)
    ]
    assert insights.latest_by_city(rows.limit(0)).count() == 0
    untimed = rows.unionAll(rows.limit(1).selectExpr("'x'", "CAST(null AS TIMESTAMP)", "7L", "70"))
    assert rows_of(insights.latest_by_city(untimed), "city", "offset") == [("a", 3), ("silent", 4), ("x", 7), (None, 5)]
    assert rows_of(insights.latest_by_city(untimed.where("city = 'x'")), "city", "offset") == [("x", 7)]


def test_trend_counts_hours_not_rows(spark):
    rows = [("a", 0, 10), ("a", 23, 20), ("a", 24, 60), ("a", 25, None), ("b", 24, 5)]
    got = rows_of(insights.trend_24h(hours_of(spark, rows)), "city", "hour_start", "aqi_avg_24h")
    assert [row[2] for row in got] == [10.0, 15.0, 40.0, 40.0, 5.0]


def test_patterns_weigh_readings(reading):
    times = ["2024-01-01 08:10", "2024-01-01 08:20", "2024-01-08 08:30", "2024-02-05 09:00"]
    rows = reading([{"city": "a", "aqi": aqi, "measurement_time": at(time)} for aqi, time in zip((1, 2, 6, 9), times)])
    hours = rollup.hourly(rows, counts=True)
    day = lambda text: at(text).date()
    assert rows_of(insights.weekly_pattern(hours), "week_start", "aqi_avg", "records") == [
        (day("2024-01-01"), 1.5, 2), (day("2024-01-08"), 6.0, 1), (day("2024-02-05"), 9.0, 1)
    ]
    assert rows_of(insights.monthly_pattern(hours), "month_start", "aqi_avg", "aqi_max") == [
        (day("2024-01-01"), 3.0, 6), (day("2024-02-01"), 9.0, 9)
    ]
    assert rows_of(insights.weekday_pattern(hours), "weekday", "hour", "aqi_avg", "pm25_avg") == [
        (0, 8, 3.0, None), (0, 9, 9.0, None)
    ]


def test_level_share(spark):
    rows = spark.createDataFrame([("a", "Low"), ("a", "Low"), ("a", "Unknown"), ("a", "Severe")],
                                 "city STRING, pollution_level STRING")
    assert insights.level_share(rows).first().asDict() == {
        "city": "a", "records": 4, "low_share": 0.5, "medium_share": 0.0, "high_share": 0.0, "severe_share": 0.25,
        "unknown_share": 0.25,
    }


def test_regions_and_cities(spark, reading):
    rows = reading([
        {"city": city, "aqi": aqi, "measurement_time": START}
        for city, aqi in [("a", 1), ("a", 3), ("b", 8), ("c", 20), ("x", 100), ("x", None)]
    ])
    dimension = spark.createDataFrame(
        [(city, city.upper(), "VN", region, 1, "z", 1, 2, 3, 4, 5) for city, region in ("aN", "bN", "cS")], DIMENSION
    )
    hours = rollup.hourly(rows, counts=True)
    assert rows_of(insights.region_rollup(hours, dimension), "region", "city", "depth", "aqi_avg", "records") == sorted([
        ("N", "a", 0, 2.0, 2), ("N", "b", 0, 8.0, 1), ("S", "c", 0, 20.0, 1), (None, "x", 0, 100.0, 2),
        ("N", None, 1, 4.0, 3), ("S", None, 1, 20.0, 1), (None, None, 1, 100.0, 2), (None, None, 3, 26.4, 6),
    ], key=str)
    assert rows_of(insights.city_comparison(hours, dimension), "city", "region", "aqi_avg", "pm25_avg", "aqi_max") == [
        ("a", "N", 2.0, None, 3), ("b", "N", 8.0, None, 8), ("c", "S", 20.0, None, 20), ("x", None, 100.0, None, 100)
    ]


def test_rank_shares_places(spark):
    day = START.date()
    rows = spark.createDataFrame([(day, "a", 1.0), (day, "b", 1.0), (day, "c", 2.0), (day, "d", None)],
                                 "date DATE, city STRING, aqi_avg DOUBLE")
    assert rows_of(insights.city_rank(rows), "city", "best_rank", "worst_rank") == [
        ("a", 1, 2), ("b", 1, 2), ("c", 3, 1)
    ]


def test_alert_runs_against_a_walk(spark):
    rng = random.Random(3)
    rows = [(city, hour, rng.choice([150, 200, 201, 320, None])) for city in "ab" for hour in range(200) if rng.random() < 0.9]
    expected = []
    for city in "ab":
        run = None
        for hour in range(201):
            value = next((aqi for c, h, aqi in rows if (c, h) == (city, hour)), None)
            if value is not None and value > 200:
                run = [hour, hour, value] if run is None else [run[0], hour, max(run[2], value)]
            elif run:
                first, last, peak = run
                expected.append((city, START + timedelta(hours=first), START + timedelta(hours=last), last - first + 1, peak))
                run = None
    hours = hours_of(spark, rows)
    assert rows_of(insights.alert_runs(hours)) == sorted(expected, key=str)
    assert insights.alert_hours(hours).count() == sum(row[3] for row in expected)


def test_weather_corr(spark, reading):
    rng = np.random.default_rng(1)
    temperature, noise = rng.normal(size=300), rng.normal(size=300)
    rows = reading([
        {"city": "a", "aqi": int(100 * t + 20 * n), "pm25": None, "temperature": float(t), "humidity": float(n)}
        for t, n in zip(temperature, noise)
    ])
    row = insights.weather_corr(rows).first()
    aqi = [int(100 * t + 20 * n) for t, n in zip(temperature, noise)]
    assert row.aqi_temperature_corr == pytest.approx(np.corrcoef(aqi, temperature)[0, 1])
    assert row.aqi_humidity_corr == pytest.approx(np.corrcoef(aqi, noise)[0, 1])
    assert row.pm25_temperature_corr is None


def test_trend_fit(spark):
    row = forecast.trend_fit(hours_of(spark, [("a", hour, 2 * hour + 5) for hour in range(50)]), "2024-01-01").first()
    assert (row.hours, round(row.slope, 9), round(row.intercept, 9), round(row.r2, 9)) == (50, 2.0, 5.0, 1.0)


def test_forecast_against_least_squares(spark):
    rng = random.Random(5)
    series = {
        city: {hour: 80 + 30 * math.sin(hour / 24 * 2 * math.pi) + rng.uniform(-9, 9) for hour in range(240) if rng.random() < 0.8}
        for city in "ab"
    }
    hours = spark.createDataFrame(
        [(city, START + timedelta(hours=hour), value) for city, known in series.items() for hour, value in known.items()],
        "city STRING, hour_start TIMESTAMP, aqi_avg DOUBLE",
    )

    def features(known, hour):
        recent = [known[h] for h in range(hour - 47, hour - 23) if h in known]
        past = [value for h, value in known.items() if h <= hour - 24]
        if not recent and not past:
            return None
        mean = sum(recent) / len(recent) if recent else sum(past) / len(past)
        angle = (hour % 24) * 2 * math.pi / 24
        return [known.get(hour - 24, mean), mean, math.sin(angle), math.cos(angle), 1.0]

    train = [(features(known, hour), value) for known in series.values() for hour, value in known.items()]
    train = [(row, value) for row, value in train if row]
    weights, *_ = np.linalg.lstsq(np.array([row for row, _ in train]), np.array([value for _, value in train]), rcond=None)
    error = np.array([np.dot(row, weights) - value for row, value in train])
    band = 1.96 * math.sqrt(np.mean(error ** 2))

    rows = forecast.features(hours)
    model = forecast.fit(rows)
    got = {(row.city, row.hour_start): row for row in forecast.forecast(rows, model).collect()}
    assert len(got) == 48
    for city, known in series.items():
        last = max(known)
        for hour in range(last + 1, last + 25):
            row = got[city, START + timedelta(hours=hour)]
            want = float(np.dot(features(known, hour), weights))
            assert row.aqi_expected == pytest.approx(want, abs=1e-6)
            assert row.aqi_high - row.aqi_expected == pytest.approx(band, abs=1e-6)
    weight = {row.feature: row.weight for row in forecast.importance(spark, model).collect()}
    assert [weight[name] for name in [*forecast.FEATURES, "intercept"]] == pytest.approx(list(weights), abs=1e-6)


def test_forecast_of_a_city_without_values_is_left_out(spark):
    hours = hours_of(spark, [("none", hour, None) for hour in range(30)] + [("a", hour, 5) for hour in range(60)])
    rows = forecast.features(hours)
    assert {row.city for row in rows.where(~F.col("known")).collect()} == {"a"}


def test_forecast_covers_every_hour_of_a_short_history(spark):
    hours = hours_of(spark, [("new", hour, 50 + hour) for hour in range(10)] + [("a", hour, hour % 24) for hour in range(90)])
    rows = forecast.features(hours)
    made = forecast.forecast(rows, forecast.fit(rows)).groupBy("city").agg(F.count("aqi_expected").alias("hours"))
    assert rows_of(made) == [("a", 24), ("new", 24)]
    coming = rows.where("city = 'new' and not known").orderBy("hour_start").collect()
    assert coming[0].day_mean == pytest.approx(54.5) and all(row.day_mean is not None for row in coming)


def test_backtest_against_least_squares(spark):
    """Weights per origin, the calibrated bands and what they cover, each by numpy on the collected features."""
    rng = random.Random(11)
    hours = hours_of(spark, [
        (city, hour, int(90 + 40 * math.sin(hour / 24 * 2 * math.pi) + rng.uniform(-25, 25)))
        for city in "abc" for hour in range(24 * 20) if rng.random() < 0.9
    ])
    rows = forecast.features(hours)
    first, split = (START + timedelta(days=6)).date(), (START + timedelta(days=13)).date()
    known = [row for row in rows.where("known and aqi_avg is not null").collect()]
    errors = {}
    for day in sorted({row.hour_start.date() for row in known}):
        if day < first:
            continue
        seen = [row for row in known if row.hour_start.date() < day]
        given = lambda row: [1.0, *[row[name] for name in forecast.FEATURES]]
        weights, *_ = np.linalg.lstsq(np.array([given(row) for row in seen]), np.array([row.aqi_avg for row in seen]), rcond=None)
        for row in known:
            if row.hour_start.date() == day:
                errors[row.city, row.hour_start] = abs(row.aqi_avg - float(np.dot(given(row), weights)))
    got = forecast.backtest_errors(rows, first).collect()
    assert {(row.city, row.hour_start) for row in got} == set(errors)
    for row in got:
        assert row.error == pytest.approx(errors[row.city, row.hour_start], abs=1e-6)
        assert row.horizon == row.hour_start.hour + 1
    found = {row.horizon: row for row in forecast.backtest(rows, first, split, percent=90).collect()}
    assert sorted(found) == list(range(1, 25))
    for horizon, row in found.items():
        early = sorted(e for (_, t), e in errors.items() if t.hour + 1 == horizon and t.date() < split)
        late = [e for (_, t), e in errors.items() if t.hour + 1 == horizon and t.date() >= split]
        place = math.ceil((len(early) + 1) * 90 / 100)
        assert (row.calibrated, row.tested) == (len(early), len(late))
        if place > len(early):
            assert row.band is None and row.covered == len(late)
        else:
            assert early[place - 1] <= row.band + 1e-9 < early[place - 1] + 0.0011
            assert row.covered == sum(e <= row.band for e in late)
    tested, covered = sum(row.tested for row in found.values()), sum(row.covered for row in found.values())
    assert 0.85 < covered / tested < 0.95


def test_a_singular_history_gives_no_weights(spark):
    """One city at one value: the regressors say the same, so there is no model and no error."""
    rows = forecast.features(hours_of(spark, [("a", hour, 0) for hour in range(24 * 5)]))
    assert forecast.backtest_errors(rows, START.date()).count() == 0
