import glob
import threading
from datetime import timedelta

import pyarrow.parquet as pq
import pytest
from rows import at, rows_of
from pyspark.sql import functions as F

from breathline.operators import dedup, parse, rollup
from breathline.plans import jobs
from breathline.schema import DIMENSION, HOURLY, MEASUREMENT
from breathline.sinks.tables import append_batch
from breathline.sources import files
from breathline.streaming import flows, run
from checks import registry

START = at("2024-01-01 10:00:00")


@pytest.fixture()
def dimension(spark):
    return spark.createDataFrame([("hot", "Hot", "VN", "North", 9, "x", 50, 100, 150, 200, 300)], DIMENSION)


@pytest.fixture()
def sent(record):
    """Four files of messages, in the order of their times: one city with most of them, one broken message."""
    parts = []
    for part in range(4):
        rows = []
        for n in range(30):
            city = "b" if n % 10 == 9 else "hot"
            time = (START + timedelta(minutes=40 * part + n)).isoformat()
            rows.append((city, "broken" if (part, n) == (2, 5) else {"aqi": part * 30 + n}, time))
        parts.append(record(rows, first_offset=part * 30))
    return parts


def land(path, parts):
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)


def read(spark, path, *columns):
    return rows_of(jobs.read_measurements(spark, path), *columns)


SHOWN = [name for name in MEASUREMENT.names if name != "processed_time"] + ["health_status", "region", "offset"]


def everything(parts):
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path, sent, dimension):
    landing, table, checkpoint = (str(tmp_path / name) for name in ("landing", "table", "checkpoint"))
    land(landing, sent[:3])
    counts = {}

    def once():
        stream = files.stream_messages(spark, landing, max_files=1)
        sink = flows.measurement_sink(table, counts.__setitem__)
        run.start(flows.realtime(stream, dimension), sink, checkpoint).awaitTermination()

    once()
    assert counts == {0: 30, 1: 30, 2: 30}
    expected = rows_of(flows.realtime(everything(sent[:3]), dimension), *SHOWN)
    assert read(spark, table, *SHOWN) == expected

    once()
    assert len(counts) == 3 and read(spark, table, *SHOWN) == expected

    land(landing, sent[3:])
    once()
    assert counts[3] == 30
    assert read(spark, table, *SHOWN) == rows_of(flows.realtime(everything(sent), dimension), *SHOWN)


def test_streams_and_checkpoints_share_a_table(spark, tmp_path, sent, dimension):
    """Batch ids begin at 0 in every checkpoint; neither a second stream nor a new checkpoint may overwrite."""
    table, archive = str(tmp_path / "table"), str(tmp_path / "archive")
    for number, part in enumerate(sent[:3]):
        landing = str(tmp_path / f"landing{number}")
        land(landing, [part])
        for _ in range(2):
            stream = files.stream_messages(spark, landing)
            jobs.run_realtime(stream, dimension, table, str(tmp_path / f"t{number}"), trigger=None).awaitTermination()
            stream = files.stream_messages(spark, landing)
            jobs.run_archive(stream, archive, str(tmp_path / f"a{number}"), trigger=None).awaitTermination()
    assert read(spark, table, "topic", "offset") == rows_of(everything(sent[:3]), "topic", "offset")
    assert rows_of(files.replay_archive(spark, archive)) == rows_of(everything(sent[:3]))
    names = {row["stream"] for row in jobs.read_measurements(spark, table).select("stream").distinct().collect()}
    assert len(names) == 3


def test_replay_adds_rows_that_can_be_told_to_be_copies(spark, tmp_path, sent, dimension):
    table, archive, hours, days = (str(tmp_path / name) for name in ("table", "archive", "hours", "days"))
    flows.archive_sink(archive)(everything(sent), 0)
    flows.measurement_sink(table)(flows.realtime(sent[0], dimension), 0)
    for _ in range(2):
        jobs.run_replay(spark, archive, dimension, table)
    assert jobs.read_measurements(spark, table).count() == 30 + 2 * 120
    try:
        for _ in range(2):
            jobs.run_hourly(spark, table, hours, drop_copies=True, name="replayed_hours")
            jobs.run_daily(spark, hours, days, name="replayed_days")
        rows = parse.parse(everything(sent))
        assert rows_of(spark.table("replayed_hours"), *HOURLY.names) == rows_of(rollup.hourly(rows))
        assert spark.table("replayed_days").agg(F.sum("total_records")).first()[0] == 120
    finally:
        for name in ("replayed_hours", "replayed_days"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_stream_leaves_a_table_with_a_name(spark, tmp_path, sent, dimension):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")
    land(landing, sent[:2])
    stream = files.stream_messages(spark, landing, max_files=1)
    try:
        jobs.run_realtime(
            stream, dimension, table, str(tmp_path / "c"), trigger=None, name="named_readings"
        ).awaitTermination()
        assert rows_of(spark.table("named_readings"), "offset") == rows_of(everything(sent[:2]), "offset")
    finally:
        spark.sql("DROP TABLE IF EXISTS named_readings")


def test_hourly_stream_job(spark, tmp_path, sent):
    landing, hours = str(tmp_path / "landing"), str(tmp_path / "hours")
    land(landing, sent)
    stream = files.stream_messages(spark, landing, max_files=2)
    jobs.run_hourly_stream(stream, hours, str(tmp_path / "c"), "1 day", trigger=None, offset_hours=3).awaitTermination()
    expected = rollup.hourly(parse.parse(everything(sent), offset_hours=3))
    assert rows_of(jobs.read_hourly(spark, hours), *HOURLY.names) == rows_of(expected)


def test_batch_run_again_leaves_one_copy(spark, tmp_path, sent, dimension):
    table = str(tmp_path / "table")
    rows = flows.realtime(sent[0], dimension)
    sink = flows.measurement_sink(table)
    for _ in range(2):
        sink(rows, 7)
    assert jobs.read_measurements(spark, table).count() == 30


def test_empty_batch_writes_nothing(spark, tmp_path, sent, dimension):
    path = tmp_path / "table"
    append_batch(str(path), ["processed_date"], ["city"])(flows.realtime(sent[0].limit(0), dimension), 0)
    flows.archive_sink(str(path))(sent[0].limit(0), 0)
    assert not list(path.rglob("part-*"))


def test_jobs_from_messages_to_days(spark, tmp_path, sent, dimension):
    landing, table, hours, days = (str(tmp_path / name) for name in ("landing", "table", "hours", "days"))
    land(landing, sent)
    stream = files.stream_messages(spark, landing)
    jobs.run_realtime(stream, dimension, table, str(tmp_path / "c"), trigger=None).awaitTermination()
    for _ in range(2):
        jobs.run_hourly(spark, table, hours)
        jobs.run_daily(spark, hours, days)
    rows = parse.parse(everything(sent))
    assert rows_of(jobs.read_hourly(spark, hours), *HOURLY.names) == rows_of(rollup.hourly(rows))
    got = spark.read.parquet(days)
    assert rows_of(got, "city", "date", "total_records") == rows_of(
        rollup.daily(rollup.hourly(rows)), "city", "date", "total_records"
    )


def test_incremental_hours_equal_all_hours(spark, tmp_path, sent, dimension):
    """A later run from an hour on, after more readings of that hour have come in."""
    table, part, full = (str(tmp_path / name) for name in ("table", "part", "full"))
    sink = flows.measurement_sink(table)
    processed = F.col("timestamp") + F.expr("INTERVAL 5 MINUTES")
    sink(flows.realtime(everything(sent[:2]), dimension, processed_time=processed), 0)
    jobs.run_hourly(spark, table, part)
    jobs.run_daily(spark, part, part + "_days")
    sink(flows.realtime(everything(sent[2:]), dimension, processed_time=processed), 1)
    since = START + timedelta(hours=8)
    jobs.run_hourly(spark, table, part, since=since)
    jobs.run_daily(spark, part, part + "_days", since=since.replace(hour=0))
    jobs.run_hourly(spark, table, full)
    assert rows_of(jobs.read_hourly(spark, part)) == rows_of(jobs.read_hourly(spark, full))
    jobs.run_daily(spark, full, full + "_days")
    assert rows_of(spark.read.parquet(part + "_days")) == rows_of(spark.read.parquet(full + "_days"))


def test_since_lists_only_the_folders_it_needs(spark, tmp_path, sent, dimension):
    table = str(tmp_path / "table")
    sink = flows.measurement_sink(table)
    for batch, days in enumerate((0, 1, 2, 5, 40)):
        processed = F.col("timestamp") + F.make_dt_interval(days=F.lit(days))
        sink(flows.realtime(sent[0], dimension, processed_time=processed), batch)
    chosen = jobs.measurements_since(spark, table, at("2024-01-04 10:20:00"))
    assert sorted({name.split("processed_date=")[1][:10] for name in chosen.inputFiles()}) == [
        "2024-01-03", "2024-01-06", "2024-02-10"
    ]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(measurement_time,2024-01-04" in plan
    assert jobs.measurements_since(spark, table, at("2024-03-01 00:00:00")).count() == 0


def test_copies_are_dropped_on_demand(spark, tmp_path, sent, dimension):
    table, once, twice = (str(tmp_path / name) for name in ("table", "once", "twice"))
    sink = flows.measurement_sink(table)
    for batch in (0, 1):
        sink(flows.realtime(sent[0], dimension), batch)
    jobs.run_hourly(spark, table, once, drop_copies=True)
    jobs.run_hourly(spark, table, twice)
    total = lambda path: jobs.read_hourly(spark, path).agg(F.sum("record_count")).first()[0]
    assert (total(once), total(twice)) == (30, 60)


def test_archive_stream(spark, tmp_path, sent):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "archive")
    land(landing, sent)
    for _ in range(2):
        stream = files.stream_messages(spark, landing, max_files=1)
        jobs.run_archive(stream, path, str(tmp_path / "c"), trigger=None).awaitTermination()
    assert rows_of(files.replay_archive(spark, path)) == rows_of(everything(sent))


def test_replays_are_dropped_across_batches(spark, tmp_path, sent, dimension):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")
    land(landing, [sent[0], sent[1], sent[0], sent[1]])
    once = dedup.drop_replays_stream(files.stream_messages(spark, landing, max_files=1), "timestamp", "1 day")
    run.start(flows.realtime(once, dimension), flows.measurement_sink(table), str(tmp_path / "c")).awaitTermination()
    assert read(spark, table, "topic", "offset") == rows_of(everything(sent[:2]), "topic", "offset")


def test_hourly_stream_over_several_batches(spark, tmp_path, sent):
    landing, hours = str(tmp_path / "landing"), str(tmp_path / "hours")
    land(landing, sent)
    stream = parse.parse(files.stream_messages(spark, landing, max_files=1))
    query = run.start(
        flows.hourly_stream(stream, "1 day"), flows.hourly_sink(spark, hours), str(tmp_path / "c"), mode="update"
    )
    query.awaitTermination()
    expected = rollup.hourly(parse.parse(everything(sent)))
    assert rows_of(jobs.read_hourly(spark, hours), *HOURLY.names) == rows_of(expected)


def test_late_reading_is_repaired_by_the_batch_job(spark, tmp_path, record, dimension):
    """Beyond the delay the stream's hours lack a late reading; the batch job recomputes them from the table."""
    parts = [
        record([("hot", {"aqi": 1}, "2024-01-01 10:00:00")]),
        record([("hot", {"aqi": 2}, "2024-01-03 10:00:00")], 1),
        record([("hot", {"aqi": 3}, "2024-01-03 11:00:00")], 2),
        record([("hot", {"aqi": 50}, "2024-01-01 10:30:00")], 3),
    ]
    landing, table, hours = (str(tmp_path / name) for name in ("landing", "table", "hours"))
    land(landing, parts)
    stream = lambda: files.stream_messages(spark, landing, max_files=1)
    jobs.run_realtime(stream(), dimension, table, str(tmp_path / "c1"), trigger=None).awaitTermination()
    run.start(
        flows.hourly_stream(parse.parse(stream()), "1 hour"), flows.hourly_sink(spark, hours), str(tmp_path / "c2"),
        mode="update",
    ).awaitTermination()
    assert jobs.read_hourly(spark, hours).agg(F.sum("record_count")).first()[0] == 3
    jobs.run_hourly(spark, table, hours)
    assert rows_of(jobs.read_hourly(spark, hours), "aqi_max", "record_count") == [(2, 1), (3, 1), (50, 2)]


def test_stopping_leaves_the_session(spark, tmp_path, sent):
    landing = str(tmp_path / "landing")
    land(landing, sent[:1])
    ran = threading.Event()
    query = run.start(
        files.stream_messages(spark, landing), lambda batch, n: ran.set(), str(tmp_path / "c"), trigger="1 hour"
    )
    waiting = threading.Thread(target=run.await_stop, args=(query,))
    waiting.start()
    assert ran.wait(60)
    query.stop()
    waiting.join(30)
    assert not waiting.is_alive() and not query.isActive and spark.range(3).count() == 3


def test_one_trigger_fills_the_cluster(spark):
    assert files.bytes_per_trigger(spark) == 4 * 8 * 128 * 1024 * 1024


def test_published_files_have_many_row_groups(spark, tmp_path, sent, monkeypatch):
    """A row group is read by one task: a file that a micro-batch takes must have more than one of them."""
    monkeypatch.setattr(registry, "LANDED_GROUP_BYTES", 1 << 12)
    many = everything(sent).crossJoin(spark.range(40)).withColumn("value", F.expr("encode(concat(uuid(), uuid()), 'utf-8')"))
    landing = registry.landed(spark, many.drop("id"), path=str(tmp_path / "landing"))
    files_made = glob.glob(f"{landing}/*.parquet")
    assert len(files_made) == registry.LANDED_FILES
    assert all(pq.ParquetFile(name).num_row_groups > 1 for name in files_made)
    assert spark.read.parquet(landing).count() == many.count()
