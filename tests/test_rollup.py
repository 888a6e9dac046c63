import random
import statistics
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from rows import at, rows_of
from pyspark.sql import functions as F

from breathline.operators import rollup
from breathline.plans import sql
from breathline.schema import DAILY, HOURLY


@pytest.fixture(scope="module")
def sample():
    """Three cities over three days, one of them with most of the rows, with gaps in every quantity."""
    rng = random.Random(7)
    rows = []
    for _ in range(1500):
        maybe = lambda value: None if rng.random() < 0.2 else value
        rows.append({
            "city": rng.choice(["hot", "hot", "hot", "b", "c", None]),
            "aqi": maybe(rng.randrange(-5, 400)),
            "pm25": maybe(rng.uniform(0, 200)), "pm10": maybe(rng.uniform(0, 200)),
            "temperature": maybe(rng.uniform(-5, 40)), "humidity": maybe(rng.uniform(0, 100)),
            "measurement_time": datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(3 * 86400)),
        })
    rows += [{"city": "b", "aqi": None, "measurement_time": at("2024-02-01 00:00:00")}]
    return rows


def near(left, right):
    if left is None or right is None or not isinstance(left, float):
        return left == right
    return left == pytest.approx(right, abs=1e-9)


def check(df, expected, keys):
    rows = df.collect()
    assert len(rows) == len(expected)
    for row in rows:
        want = expected[tuple(row[key] for key in keys)]
        assert all(near(row[name], want[name]) for name in want), (row, want)


def summary(rows, names_stats):
    functions = {"avg": statistics.fmean, "max": max, "min": min, "stddev": statistics.pstdev}
    found = {}
    for name, stats in names_stats.items():
        present = [row[name] for row in rows if row.get(name) is not None]
        for stat in stats:
            found[f"{name}_{stat}"] = functions[stat](present) if present else None
    return found


def by_hour(sample):
    groups = defaultdict(list)
    for row in sample:
        groups[row["city"], row["measurement_time"].replace(minute=0, second=0)].append(row)
    return {key: {**summary(rows, rollup.STATISTICS), "record_count": len(rows)} for key, rows in groups.items()}


def test_hourly(reading, sample):
    hours = rollup.hourly(reading(sample))
    assert hours.columns == HOURLY.names and [f.dataType for f in hours.schema] == [f.dataType for f in HOURLY]
    check(hours, by_hour(sample), ["city", "hour_start"])


def test_single_reading_has_zero_deviation(reading):
    row = rollup.hourly(reading([{"city": "a", "aqi": 4, "measurement_time": at("2024-01-01 00:59:59")}])).first()
    assert (row.aqi_stddev, row.hour_start, row.pm25_avg, row.record_count) == (0.0, at("2024-01-01"), None, 1)


def test_daily_weighs_hours_alike(reading, sample):
    groups = defaultdict(list)
    for (city, hour), row in by_hour(sample).items():
        groups[city, hour.date()].append(row)
    expected = {}
    for key, rows in groups.items():
        want = {"total_records": sum(row["record_count"] for row in rows)}
        for name, stats in rollup.STATISTICS.items():
            for stat in set(stats) - {"stddev"}:
                present = [row[f"{name}_{stat}"] for row in rows if row[f"{name}_{stat}"] is not None]
                function = {"avg": statistics.fmean, "max": max, "min": min}[stat]
                want[f"{name}_{stat}"] = function(present) if present else None
        expected[key] = want
    days = rollup.daily(rollup.hourly(reading(sample)))
    assert days.columns == DAILY.names and [f.dataType for f in days.schema] == [f.dataType for f in DAILY]
    check(days, expected, ["city", "date"])


def test_weighted_day_is_the_mean_of_the_readings(reading, sample):
    groups = defaultdict(list)
    for row in sample:
        groups[row["city"], row["measurement_time"].date()].append(row)
    means = {name: ["avg"] for name in rollup.STATISTICS}
    expected = {key: {**summary(rows, means), "total_records": len(rows)} for key, rows in groups.items()}
    check(rollup.daily_weighted(rollup.hourly(reading(sample), counts=True)), expected, ["city", "date"])


def test_sql_text_gives_the_same(spark, reading, sample):
    rows = reading(sample)
    hours = rollup.hourly(rows)
    assert rows_of(sql.hourly_sql(spark, rows)) == rows_of(hours)
    assert rows_of(sql.daily_sql(spark, hours)) == rows_of(rollup.daily(hours))
    assert not spark.catalog.tableExists("measurements") and not spark.catalog.tableExists("hours")


def test_view_goes_away_even_if_the_query_fails(spark):
    with pytest.raises(Exception):
        sql.over_view(spark, "short_lived", spark.range(1), lambda view: f"SELECT nothing FROM {view}")
    assert not spark.catalog.tableExists("short_lived")


def test_weekly(spark):
    days = [("a", at(f"2024-01-{day:02d}").date(), float(day), 2) for day in range(1, 11)]
    df = spark.createDataFrame(days, "city STRING, date DATE, aqi_avg DOUBLE, total_records BIGINT")
    for name in ("aqi_max", "aqi_min"):
        df = df.withColumn(name, F.col("aqi_avg").cast("int"))
    for name in rollup.STATISTICS:
        for stat in ("avg", "max", "min"):
            if f"{name}_{stat}" not in df.columns:
                df = df.withColumn(f"{name}_{stat}", F.lit(1.0))
    got = rows_of(rollup.weekly(df), "week_start", "aqi_avg", "aqi_max", "total_records")
    assert got == [(at("2024-01-01").date(), 4.0, 7, 14), (at("2024-01-08").date(), 9.0, 10, 6)]


def test_union_matches_by_name(spark):
    one = spark.createDataFrame([(1, "x")], "n INT, s STRING")
    two = spark.createDataFrame([("y", 2)], "s STRING, n INT")
    assert rows_of(rollup.union_all([one, two, one])) == [(1, "x"), (1, "x"), (2, "y")]


def test_of_cities(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], "city STRING, n INT")
    wanted = spark.createDataFrame([("a",), ("a",), ("z",)], "city STRING")
    assert rows_of(rollup.of_cities(rows, wanted)) == [("a", 1), ("a", 3)]


def test_hourly_plan_pre_aggregates_and_reads_what_it_needs(spark, reading, sample, tmp_path):
    reading(sample).write.parquet(str(tmp_path / "m"))
    hours = rollup.hourly(spark.read.parquet(str(tmp_path / "m")))
    plan = hours._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
    read = plan.split("ReadSchema:")[1]
    assert "station_name" not in read and "dominant_pollutant" not in read
