"""The dimension as it was at the time of the reading."""

import random
from datetime import timedelta

from rows import at, rows_of
from pyspark.sql import functions as F

from breathline.operators import enrich
from breathline.schema import DIMENSION

START = at("2024-01-01 00:00:00")


def history_of(spark, rows):
    """(city, hour it begins, its good bound) as a dimension with versions."""
    made = [(city, city, "VN", "R", 1, "z", good, 100, 150, 200, 300, None if hour is None else START + timedelta(hours=hour))
            for city, hour, good in rows]
    fields = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in DIMENSION)
    return spark.createDataFrame(made, f"{fields}, valid_from timestamp")


def readings_of(spark, rows):
    made = [(number, city, None if hour is None else START + timedelta(hours=hour)) for number, (city, hour) in enumerate(rows)]
    return spark.createDataFrame(made, "id long, city string, measurement_time timestamp").withColumn("valid_from", F.lit("own"))


def test_against_a_search(spark):
    rng = random.Random(2)
    history = [(city, hour, 10 * hour + len(city)) for city in ("hot", "b", "cc") for hour in rng.sample(range(60), 8)]
    rows = [("hot" if rng.random() < 0.7 else rng.choice(["b", "cc", "new", None]), rng.choice([None, *range(-3, 70)])) for _ in range(400)]
    expected = []
    for number, (city, hour) in enumerate(rows):
        known = [(begin, good) for named, begin, good in history if named == city and hour is not None and begin <= hour]
        expected.append((number, max(known)[1] if known else None))
    readings, versions = readings_of(spark, rows), history_of(spark, history)
    for limit in (100_000, 3):  # broadcast, and shuffled
        found = enrich.enrich_as_of(readings, versions, max_rows=limit)
        assert found.columns == [*readings.columns, *DIMENSION.names[1:]]
        assert rows_of(found, "id", "aqi_threshold_good") == sorted(expected, key=str)


def test_ties_and_rows_that_are_no_version(spark):
    history = history_of(spark, [("a", 5, 10), ("a", 5, 30), ("a", 5, 20), ("a", None, 99), (None, 0, 98), ("a", 9, 40)])
    assert rows_of(enrich.versions(history), "city", "valid_from", "valid_to", "aqi_threshold_good") == [
        ("a", START + timedelta(hours=5), START + timedelta(hours=9), 30), ("a", START + timedelta(hours=9), None, 40),
    ]
    readings = readings_of(spark, [("a", 4), ("a", 5), ("a", 8), ("a", 9), (None, 9), ("a", 5)])
    assert [row[1] for row in sorted(rows_of(enrich.enrich_as_of(readings, history), "id", "aqi_threshold_good"))] == [
        None, 30, 30, 40, None, 30
    ]
    none = history.limit(0)
    assert enrich.enrich_as_of(readings, none).where("city_name is null").count() == 6
    assert enrich.enrich_as_of(readings.limit(0), history).count() == 0
