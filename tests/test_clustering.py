import glob
import os
from datetime import date, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType, TimestampType
from rows import at, rows_of

from breathline import workspace
from breathline.plans import jobs
from breathline.schema import DIMENSION
from breathline.sinks import clustering
from breathline.sinks.tables import write_partitioned
from breathline.streaming import flows

SCHEMA = StructType().add("n", LongType()).add("city", StringType()).add("time", TimestampType()).add("value", DoubleType())
START = at("2024-01-01 00:00:00")
KEYS = ["city", "time"]


def made(n):
    """A third of all rows in one city, some without a city, some without a time, some times alike."""
    city = "m-hot" if n % 3 == 0 else None if n % 41 == 0 else f"c{n * 7919 % 50:02d}"
    time = None if n % 43 == 0 else START + timedelta(minutes=n * 104729 % 50_000 // 5 * 5)
    return n, city, time, float(n % 10)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([made(n) for n in range(20_000)], SCHEMA)


@pytest.fixture(scope="module")
def table(rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clustered") / "table")
    clustering.write_clustered(rows, path, KEYS, 64)
    return path


def meets(name, low, high):
    return lambda row: row[name] is not None and (low is None or row[name] >= low) and (high is None or row[name] <= high)


@pytest.mark.parametrize("bounds", [
    {},
    {"city": ("c07", "c07")},
    {"city": ("m-hot", "m-hot"), "time": (START + timedelta(days=3), START + timedelta(days=4))},
    {"city": ("c10", "c20"), "time": (None, START + timedelta(days=2))},
    {"time": (START + timedelta(days=30), None)},
    {"city": (None, None), "time": (START, START)},
    {"city": ("x", "z")},
])
def test_scans_equal_filters(spark, rows, table, bounds):
    tests = [meets(name, *ends) for name, ends in bounds.items() if ends != (None, None)]
    expected = [row for row in rows.collect() if all(test(row) for test in tests)]
    found = clustering.read_clustered(spark, table, SCHEMA, bounds)
    assert found.schema == SCHEMA
    assert rows_of(found) == sorted((tuple(row) for row in expected), key=str)


def test_few_files_are_opened(spark, table):
    assert len(glob.glob(f"{table}/g1/rows/*.parquet")) == 64
    one_city = clustering.files_within(spark, table, {"city": ("c07", "c07")})
    some_days = clustering.files_within(spark, table, {"time": (START + timedelta(days=3), START + timedelta(days=4))})
    both = clustering.files_within(
        spark, table, {"city": ("c07", "c07"), "time": (START + timedelta(days=3), START + timedelta(days=4))}
    )
    assert len(one_city) <= 16 and len(some_days) <= 24 and 1 <= len(both) <= 4
    opened = clustering.read_clustered(spark, table, SCHEMA, {"city": ("c07", "c07")}).inputFiles()
    assert sorted(os.path.basename(name) for name in opened) == one_city


def rows_read(files, cities, times):
    """Rows of the row groups whose statistics do not rule out a row of the cities and times."""
    read = 0
    for name in files:
        data = pq.ParquetFile(name).metadata
        places = {data.row_group(0).column(at).path_in_schema: at for at in range(data.num_columns)}
        for group in range(data.num_row_groups):
            limits = [data.row_group(group).column(places[key]).statistics for key in KEYS]
            if all(
                known.has_min_max and str(known.min) <= str(high) and str(known.max) >= str(low)
                for known, (low, high) in zip(limits, (cities, times))
            ):
                read += data.row_group(group).num_rows
    return read


def test_less_is_read_than_by_date(spark, rows, table, tmp_path):
    """Against a folder per date, sorted by city: the layout of the measurement table."""
    beside = str(tmp_path / "dated")
    write_partitioned(rows.withColumn("date", F.to_date("time")), beside, ["date"], KEYS)
    cities, times = ("c07", "c07"), (START, START + timedelta(days=40))
    dated, clustered = glob.glob(f"{beside}/*/*.parquet"), glob.glob(f"{table}/g1/rows/*.parquet")
    assert 4 * rows_read(clustered, cities, times) <= rows_read(dated, cities, times)


def test_hot_and_missing_values_are_spread(spark, table):
    """No file holds much more than its share, though one city has a third of all rows."""
    sizes = [row["rows"] for row in clustering.zones(spark, table).collect()]
    assert sum(sizes) == 20_000 and len(sizes) == 64 and max(sizes) < 3 * 20_000 / 64


def test_rows_all_alike(spark, tmp_path):
    same = spark.createDataFrame([(n, "a", START, 1.0) for n in range(2000)], SCHEMA)
    nothing = spark.createDataFrame([(n, None, None, None) for n in range(2000)], SCHEMA)
    for name, alike in (("same", same), ("nothing", nothing)):
        path = str(tmp_path / name)
        clustering.write_clustered(alike, path, KEYS, 4)
        assert rows_of(clustering.read_clustered(spark, path, SCHEMA)) == rows_of(alike)
        assert len(clustering.files_within(spark, path, {})) == 4
    assert clustering.read_clustered(spark, path, SCHEMA, {"city": ("a", "a")}).count() == 0


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "empty")
    clustering.write_clustered(spark.createDataFrame([], SCHEMA), path, KEYS, 4)
    assert clustering.read_clustered(spark, path, SCHEMA).count() == 0
    assert clustering.read_clustered(spark, path, SCHEMA, {"city": ("a", "b")}).count() == 0


def test_no_table(spark, tmp_path):
    with pytest.raises(ValueError, match="no complete table"):
        clustering.read_clustered(spark, str(tmp_path / "none"), SCHEMA)


def test_generations(spark, rows, tmp_path, monkeypatch):
    """The next generation takes the place of the last; one that died is not read and goes with the run after it."""
    path = str(tmp_path / "table")
    clustering.write_clustered(rows.where("n < 10"), path, KEYS, 2)
    open_scan = clustering.read_clustered(spark, path, SCHEMA)
    with monkeypatch.context() as patch:
        patch.setattr(workspace, "mark", lambda *_: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError, match="died"):
            clustering.write_clustered(rows.where("n < 20"), path, KEYS, 2)
    assert clustering.read_clustered(spark, path, SCHEMA).count() == 10
    clustering.write_clustered(rows.where("n < 30"), path, KEYS, 2)
    assert clustering.read_clustered(spark, path, SCHEMA).count() == 30 and open_scan.count() == 10
    clustering.write_clustered(rows.where("n < 40"), path, KEYS, 2)
    assert workspace.folders(spark, path) == ["g2", "g3"]
    assert clustering.read_clustered(spark, path, SCHEMA).count() == 40


def test_codes_follow_the_order(spark):
    """Codes never fall as the key rises, and interleaving keeps each key's order while the other stands still."""
    values = [f"c{n:03d}" for n in range(200)]
    frame = spark.createDataFrame([(value,) for value in values], "city string")
    code = clustering._code(F.col("city"), clustering._bounds(values, 4))
    found = [row[0] for row in frame.orderBy("city").select(code).collect()]
    assert found == sorted(found) and set(found) == set(range(16))
    pairs = spark.range(64).select((F.col("id") % 8).alias("a"), F.floor(F.col("id") / 8).cast("long").alias("b"))
    z = pairs.select("a", "b", clustering.interleaved([F.col("a"), F.col("b")], 3).alias("z")).collect()
    expected = {
        (row["a"], row["b"]): sum(
            (row["a"] >> bit & 1) << 2 * bit + 1 | (row["b"] >> bit & 1) << 2 * bit for bit in range(3)
        ) for row in z
    }
    assert all(row["z"] == expected[row["a"], row["b"]] for row in z) and len({row["z"] for row in z}) == 64


def test_too_many_bits(rows):
    with pytest.raises(ValueError, match="do not fit"):
        clustering.curve(rows, ["n", "city", "time"], bits=32)


def test_measurements_of_some_dates(spark, tmp_path, record):
    source, path = str(tmp_path / "m"), str(tmp_path / "by-city")
    sent = record([(f"c{n % 5}", {"aqi": n}, (START + timedelta(hours=n)).isoformat()) for n in range(96)])
    dimension = spark.createDataFrame([("c1", "One", "VN", "North", 9, "x", 50, 100, 150, 200, 300)], DIMENSION)
    stored = flows.realtime(sent, dimension, processed_time=F.col("timestamp"))
    flows.measurement_sink(source, owner="s")(stored, 0)
    assert jobs.cluster_measurements(spark, source, path, date(2024, 1, 2), date(2024, 1, 4)) == 1
    expected = jobs.read_measurements(spark, source).where("processed_date in ('2024-01-02', '2024-01-03')")
    assert expected.count() == 48
    assert rows_of(jobs.scan_measurements(spark, path)) == rows_of(expected)
    found = jobs.scan_measurements(spark, path, ("c1", "c2"), (None, START + timedelta(hours=40)))
    assert rows_of(found) == rows_of(expected.where(
        F.col("city").between("c1", "c2") & (F.col("measurement_time") <= F.lit(START + timedelta(hours=40)))
    ))
