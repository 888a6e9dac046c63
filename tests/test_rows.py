"""Parsing, publishing, quarantine, enrichment, replays."""

import json

from rows import at, rows_of
from pyspark.sql import functions as F

from breathline.operators import dedup, enrich, parse, publish
from breathline.schema import DIMENSION, ENVELOPE, MEASUREMENT, RECORD
from breathline.sources.files import read_dimension

FULL = {
    "aqi": 57, "idx": 1583, "dominentpol": "pm25",
    "iaqi": {"pm25": {"v": 57.5}, "pm10": {"v": 20}, "t": {"v": 31.2}, "h": {"v": 70}},
    "time": {"s": "2024-01-01 07:00:00", "tz": "+07:00", "v": 99999999999},
    "city": {"name": "Station", "geo": [21.0, 105.8]},
}
NOON = "2024-01-01 12:00:00"


def parsed(df):
    return [row.asDict() for row in parse.parse(df, keep=["offset"]).orderBy("offset").collect()]


def test_full_envelope(record):
    row = parsed(record([("hanoi", FULL, NOON)]))[0]
    assert row.pop("processed_time") is not None
    assert row == {
        "city": "hanoi", "aqi": 57, "station_id": 1583, "dominant_pollutant": "pm25", "pm25": 57.5, "pm10": 20.0,
        "temperature": 31.2, "humidity": 70.0, "measurement_time": at("2024-01-01 19:00:00"),
        "station_name": "Station", "latitude": 21.0, "longitude": 105.8, "offset": 0,
    }


def test_bad_parts_stay_local(record):
    rows = parsed(record([
        ("a", {**FULL, "aqi": "-"}, NOON),
        ("b", {**FULL, "aqi": 55.5}, NOON),
        ("c", {**FULL, "city": {"name": "S", "geo": []}}, NOON),
        ("d", {**FULL, "city": {"name": "S"}}, NOON),
        ("e", None, NOON),
        ("f", json.dumps({"city": "f", "payload": "over quota"}), NOON),
        ("g", "no json at all", NOON),
        ("h", {**FULL, "city": {"name": "S", "geo": [1.5]}}, NOON),
    ]))
    assert [row["city"] for row in rows] == ["a", "b", "c", "d", "e", "f", None, "h"]
    assert [row["aqi"] for row in rows] == [None, None, 57, 57, None, None, None, 57]
    assert [row["pm25"] for row in rows] == [57.5] * 4 + [None] * 3 + [57.5]
    assert [row["latitude"] for row in rows] == [21.0, 21.0, None, None, None, None, None, 1.5]
    assert rows[7]["longitude"] is None
    assert all(row["measurement_time"] == at("2024-01-01 19:00:00") for row in rows)


def test_column_order(record):
    assert parse.parse(record([("a", FULL, NOON)])).columns == MEASUREMENT.names


def test_quarantine_keeps_every_row(record):
    rows = record([
        ("a", FULL, NOON), ("b", {**FULL, "aqi": "-"}, NOON), ("c", "{", NOON), ("d", '{"payload": {"aqi": 3}}', NOON),
    ])
    checked = parse.parse_checked(rows, keep=["offset"])
    assert [row[0] for row in checked.orderBy("offset").select("problem").collect()] == [
        None, "bad_field", "no_city", "no_city"
    ]
    for strict, expected in ((False, [0, 1]), (True, [0])):
        valid, rejected = parse.split(checked, strict)
        good = sorted(row.offset for row in valid.collect())
        assert good == expected
        assert sorted(row.offset for row in rejected.collect()) == [n for n in range(4) if n not in expected]
    assert ENVELOPE.names == ["city", "payload"]


def test_publish_then_parse(reading, spark):
    rows = reading([
        {"city": "hue", "aqi": 5, "station_id": 7, "pm25": 1.25, "temperature": -3.0, "station_name": 'q"uote\n',
         "latitude": 1.0, "longitude": 2.0},
        {"city": "hue", "humidity": 0.1},
    ])
    sent = publish.publish(rows.withColumns({
        "partition": F.lit(0), "offset": F.monotonically_increasing_id(), "timestamp": F.lit(at(NOON)),
    }))
    assert sent.columns == RECORD.names
    assert {(bytes(row.key), row.topic) for row in sent.collect()} == {(b"hue", "raw.airquality.hue")}
    kept = [name for name in MEASUREMENT.names if name not in ("measurement_time", "processed_time")]
    assert rows_of(parse.parse(sent), *kept) == rows_of(rows, *kept)


def test_dimension_file_has_declared_types(spark, tmp_path):
    path = tmp_path / "cities.json"
    path.write_text(json.dumps({"city": "hue", "region": "Central", "population": 9, "aqi_threshold_good": 50}) + "\n")
    read = read_dimension(spark, str(path))
    assert read.schema == DIMENSION and read.first().region == "Central"


def test_enrich_keeps_unknown_and_missing_cities(spark, reading):
    rows = reading([{"city": "hue", "aqi": 1}, {"city": "nowhere", "aqi": 2}, {"aqi": 3}])
    dimension = spark.createDataFrame([("hue", "Hue", "VN", "Central", 9, "x", 1, 2, 3, 4, 5)], DIMENSION)
    results = []
    for bound in (10, 0):
        joined = enrich.enrich_city(rows, dimension, max_rows=bound)
        plan = joined._jdf.queryExecution().logical().toString()
        assert ("broadcast" in plan) == (bound > 0)
        results.append(rows_of(joined, "aqi", "city", "region"))
        assert joined.columns.count("city") == 1
    assert results[0] == results[1] == [(1, "hue", "Central"), (2, "nowhere", None), (3, None, None)]


def test_hot_city_is_split_beyond_the_broadcast_bound(spark):
    """A third of the rows in one city: the shuffled join cuts that city's rows into several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        cities = [(f"c{n}", f"C{n}", "VN", "North", n, "x", 1, 2, 3, 4, 5) for n in range(50)]
        rows = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 60)).alias("city"),
            F.xxhash64("id").alias("value"),
        )
        joined = enrich.enrich_city(rows, spark.createDataFrame(cities, DIMENSION), max_rows=0).agg(
            F.count("*").alias("rows"), F.count("region").alias("known"), F.bit_xor("value").alias("values")
        )
        row = joined.collect()[0]
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        assert row.rows == 300_000 and row["values"] == rows.agg(F.bit_xor("value")).first()[0]
        assert row.known == rows.where(F.expr("city <> 'hot' AND int(substr(city, 2)) < 50")).count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_rows_without_a_message_id_all_stay(record):
    known = record([("a", {"aqi": n}, "2024-01-01 10:00:00") for n in range(3)])
    unknown = known.withColumn("offset", F.lit(None).cast("long"))
    both = known.unionByName(known).unionByName(unknown).unionByName(unknown)
    assert rows_of(dedup.drop_replays(both), "offset").count((None,)) == 6
    assert dedup.drop_replays(both).count() == 9


def test_payload_clock(record):
    rows = record([
        ("a", {"aqi": 1, "time": {"s": "2024-03-01 08:30:00"}}, "2024-01-01 10:00:00"),
        ("b", {"aqi": 1, "time": {"s": "soon"}}, "2024-01-01 10:00:00"),
    ])
    assert rows_of(parse.parse(rows, event_time="payload"), "city", "measurement_time") == [
        ("a", at("2024-03-01 08:30:00")), ("b", at("2024-01-01 17:00:00"))
    ]


def test_wrap_keeps_the_whole_payload(spark):
    payload = '{"aqi": 7, "time": {"s": "x", "v": 1}, "other": [1, {"deep": "\\u00fc"}]}'
    rows = spark.createDataFrame([('h"u\\e', payload), (None, None), ("a", " ")], "city string, payload string")
    found = [json.loads(row[0]) for row in rows.select(publish.wrap(F.col("city"), F.col("payload"))).collect()]
    assert found == [
        {"city": 'h"u\\e', "payload": json.loads(payload)}, {"city": None, "payload": None},
        {"city": "a", "payload": None},
    ]


def test_drop_replays(record):
    one = record([("hue", FULL, NOON), ("hue", FULL, NOON)])
    other = record([("hoian", FULL, NOON)])
    again = one.unionByName(other).unionByName(one).unionByName(one)
    assert rows_of(dedup.drop_replays(again), "topic", "offset") == [
        ("raw.airquality.hoian", 0), ("raw.airquality.hue", 0), ("raw.airquality.hue", 1)
    ]
