import glob
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from rows import at, rows_of

from breathline import workspace
from breathline.operators import archive, moments
from breathline.plans import jobs
from breathline.schema import DIMENSION, STORED
from breathline.sinks import compaction
from breathline.sinks.tables import append_batch
from breathline.sources import files
from breathline.streaming import flows

START = at("2024-01-30 06:00:00")
CLOSED = date(2024, 1, 31)


@pytest.fixture()
def messages(record):
    return [
        record([("hot" if n % 5 else "b", {"aqi": n}, (START + timedelta(hours=2 * n)).isoformat()) for n in range(20)],
               first_offset=20 * part)
        for part in range(4)
    ]


@pytest.fixture()
def table(spark, tmp_path, messages):
    """Four batches in two dates, several files in each folder."""
    path = str(tmp_path / "table")
    dimension = spark.createDataFrame([("hot", "Hot", "VN", "North", 9, "x", 50, 100, 150, 200, 300)], DIMENSION)
    for batch, part in enumerate(messages):
        rows = flows.realtime(part, dimension, processed_time=F.col("timestamp"))
        flows.measurement_sink(path, owner=f"s{batch % 2}")(rows.repartition(3), batch)
    return path


SHOWN = [name for name in STORED.names if name not in ("stream", "batch_id")]


def shown(spark, path):
    return rows_of(jobs.read_measurements(spark, path), *SHOWN)


def found(path, pattern):
    return sorted(glob.glob(f"{path}/{pattern}"))


def test_rows_stay_and_files_are_few(spark, table):
    before = shown(spark, table)
    assert len(found(table, "processed_date=2024-01-30/*/*/*.parquet")) > 4
    assert jobs.compact_measurements(spark, table, CLOSED) == ["processed_date=2024-01-30"]
    assert shown(spark, table) == before
    assert len(found(table, "processed_date=2024-01-30/*/*/*.parquet")) == 1
    assert found(table, "processed_date=2024-01-30/*") == found(table, "processed_date=2024-01-30/stream=compacted")
    assert len(found(table, "processed_date=2024-01-31/*")) == 2
    assert jobs.compact_measurements(spark, table, CLOSED) == []
    assert len(jobs.compact_measurements(spark, table, date.max)) == 1 and shown(spark, table) == before


def test_late_rows_are_taken_in_by_the_next_run(spark, table, messages):
    jobs.compact_measurements(spark, table, date.max)
    late = jobs.read_measurements(spark, table).where("offset = 3").withColumn("offset", F.lit(500).cast("long"))
    append_batch(table, ["processed_date"], ["city"], owner="late")(late.drop("stream", "batch_id"), 0)
    before = shown(spark, table)
    assert len(before) == 81
    assert jobs.compact_measurements(spark, table, date.max) == ["processed_date=2024-01-30"]
    assert shown(spark, table) == before
    assert found(table, "processed_date=2024-01-30/*/*") == found(table, "processed_date=2024-01-30/stream=compacted/batch_id=1")


def test_file_size_is_a_target(spark, table):
    before = shown(spark, table)
    assert jobs.compact_measurements(spark, table, date.max, target_bytes=1) == []
    assert jobs.compact_measurements(spark, table, date.max, target_bytes=40_000) != []
    assert shown(spark, table) == before


@pytest.mark.parametrize("step", ["write_text", "move", "remove"])
@pytest.mark.parametrize("call", [0, 2])
def test_a_run_that_dies_is_completed(spark, table, monkeypatch, step, call):
    before, real, calls = shown(spark, table), getattr(workspace, step), []

    def dying(*given):
        calls.append(given)
        if len(calls) == call + 1:
            raise RuntimeError("gone")
        return real(*given)

    with monkeypatch.context() as patch:
        patch.setattr(workspace, step, dying)
        try:
            jobs.compact_measurements(spark, table, date.max)
        except RuntimeError:
            pass
    with pytest.warns(UserWarning, match="dropped") if (step, call) == ("write_text", 0) else _nothing():
        jobs.compact_measurements(spark, table, date.max)
    assert shown(spark, table) == before
    assert len(found(table, "*/*/*/*.parquet")) == 2 and not workspace.exists(spark, compaction._beside(spark, table))


class _nothing:
    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False


def test_folders_that_arrive_meanwhile_are_left_alone(spark, table, monkeypatch):
    before, real = shown(spark, table), workspace.write_text

    def arriving(*given):
        rows = jobs.read_measurements(spark, table).where("offset = 1").limit(1).withColumn("offset", F.lit(900).cast("long"))
        append_batch(table, ["processed_date"], ["city"], owner="new")(rows.drop("stream", "batch_id"), 0)
        real(*given)

    monkeypatch.setattr(workspace, "write_text", arriving)
    jobs.compact_measurements(spark, table, CLOSED)
    assert len(shown(spark, table)) == len(before) + 1
    assert len(found(table, "processed_date=2024-01-30/stream=new/*/*.parquet")) == 1


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_archive(spark, tmp_path, messages, fmt):
    path = str(tmp_path / "archive")
    for batch, part in enumerate(messages):
        archive.write_archive(part, path, fmt, batch)
    before = rows_of(files.read_archive(spark, path, fmt).drop("stream", "batch_id"))
    done = jobs.compact_archive(spark, path, CLOSED, fmt)
    assert done == [f"city={city}/year=2024/month=01/day=30" for city in ("b", "hot")]
    assert rows_of(files.read_archive(spark, path, fmt).drop("stream", "batch_id")) == before
    assert len(found(path, f"city=hot/year=2024/month=01/day=30/*/*/*.{fmt}*")) == 1


def test_moments_become_one_row_an_hour(spark, tmp_path, messages):
    path = str(tmp_path / "moments")
    for batch, part in enumerate(messages):
        flows.moments_sink(path)(flows.parse(part), batch)
    before = rows_of(jobs.hours_from_moments(spark, path))
    assert jobs.read_moments(spark, path).count() == 80
    jobs.compact_moments(spark, path, date.max)
    assert jobs.read_moments(spark, path).count() == 20 and rows_of(jobs.hours_from_moments(spark, path)) == before
    assert jobs.read_moments(spark, path).columns == [*moments.MOMENTS.names, "date", "stream", "batch_id"]


def test_no_table(spark, tmp_path):
    assert jobs.compact_measurements(spark, str(tmp_path / "none"), date.max) == []
