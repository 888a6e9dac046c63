"""The archive and then the live stream: each message once, wherever the job stops."""

from datetime import timedelta

import pytest
from rows import at, rows_of

from breathline.plans import jobs
from breathline.operators.intervals import offset_intervals
from breathline.schema import DIMENSION, RECORD
from breathline.sources import files
from breathline.sources.broker import broker_options
from breathline.streaming import flows, handover

ID = ["topic", "partition", "offset"]


@pytest.fixture()
def dimension(spark):
    return spark.createDataFrame([("hot", "Hot", "VN", "North", 9, "x", 50, 100, 150, 200, 300)], DIMENSION)


def sent(record, first, last):
    start = at("2024-01-01 10:00:00")
    return record(
        [("b" if n % 7 == 0 else "hot", {"aqi": n}, (start + timedelta(minutes=7 * n)).isoformat()) for n in range(first, last)],
        first_offset=first,
    )


def land(path, part):
    part.coalesce(1).write.mode("append").parquet(path)


@pytest.fixture()
def places(tmp_path):
    return {name: str(tmp_path / name) for name in ("archive", "landing", "table", "checkpoint")}


def replay(spark, places, dimension, **more):
    def live(starting):
        assert starting == {}
        return files.stream_messages(spark, places["landing"], max_files=1)

    return jobs.run_replay_stream(
        spark, places["archive"], live, dimension, places["table"], places["checkpoint"], trigger=None, **more
    )


def stored(spark, places):
    return rows_of(jobs.read_measurements(spark, places["table"]), *ID, "aqi")


def expected(record, dimension, first, last):
    return rows_of(flows.realtime(sent(record, first, last), dimension), *ID, "aqi")


def test_each_message_once_with_restarts(spark, record, dimension, places):
    for number, (first, last) in enumerate([(0, 30), (20, 40)]):  # the archive holds some messages twice
        flows.write_archive(sent(record, first, last), places["archive"], batch_id=number)
    land(places["landing"], sent(record, 30, 50))
    replay(spark, places, dimension, max_files=3).awaitTermination()
    assert stored(spark, places) == expected(record, dimension, 0, 50)

    # What the archive files after the hand-over comes from the live stream, which sends some messages again.
    flows.write_archive(sent(record, 40, 60), places["archive"], batch_id=2)
    land(places["landing"], sent(record, 45, 60).unionByName(sent(record, 55, 60)))
    replay(spark, places, dimension).awaitTermination()
    replay(spark, places, dimension).awaitTermination()
    assert stored(spark, places) == expected(record, dimension, 0, 60)
    held = handover.held_intervals(spark, f"{places['checkpoint']}/held")
    assert rows_of(held.select("first", "last")) == rows_of(offset_intervals(sent(record, 0, 60)).select("first", "last"))


def test_a_crash_in_the_archive_phase(spark, record, dimension, places, monkeypatch):
    """The table has the batch's rows and the run dies before the batch is committed: it is repeated, and the hand-over
    waits for it."""
    flows.write_archive(sent(record, 0, 30), places["archive"])
    land(places["landing"], sent(record, 10, 35))
    real = jobs.measurement_sink

    def dies(*given, **named):
        write = real(*given, **named)

        def sink(batch, batch_id):
            write(batch, batch_id)
            raise RuntimeError("lost")

        return sink

    monkeypatch.setattr(jobs, "measurement_sink", dies)
    with pytest.raises(Exception, match="lost"):
        replay(spark, places, dimension)
    monkeypatch.undo()
    assert len(stored(spark, places)) == 30
    replay(spark, places, dimension).awaitTermination()
    assert stored(spark, places) == expected(record, dimension, 0, 35)


def test_no_archive_and_rows_without_an_id(spark, record, dimension, places):
    nameless = sent(record, 0, 5).unionByName(sent(record, 0, 5)).drop("offset").selectExpr(
        "key", "value", "topic", "partition", "cast(null as bigint) as offset", "timestamp"
    )
    land(places["landing"], sent(record, 0, 5).unionByName(nameless).select(*RECORD.names))
    replay(spark, places, dimension).awaitTermination()
    rows = stored(spark, places)
    assert len(rows) == 15 and [row for row in rows if row[2] is not None] == expected(record, dimension, 0, 5)


def test_repeated_batch_stores_the_same(spark, record, dimension, tmp_path):
    held, table = str(tmp_path / "held"), str(tmp_path / "table")
    sink = handover.once_sink(flows.measurement_sink(table, owner="s"), held, "live")
    for batch_id, (first, last) in enumerate([(0, 10), (5, 15), (5, 15), (12, 20)]):
        for _ in range(2):
            sink(flows.realtime(sent(record, first, last), dimension), batch_id)
    assert rows_of(jobs.read_measurements(spark, table), *ID, "aqi") == expected(record, dimension, 0, 20)
    assert len(handover._states(spark, held)) == 2


def test_starting_offsets(spark):
    held = spark.createDataFrame(
        [("t.a", 0, 3, 9), ("t.a", 0, 12, 20), ("t.a", 1, 0, 4), ("t.c", 0, 0, 1)], "topic string, partition int, first long, last long"
    )
    begin = handover.starting_offsets(held, {"t.a": 3, "t.b": 1})
    assert begin == {"t.a": {"0": 10, "1": 5, "2": -2}, "t.b": {"0": -2}}
    assert handover.starting_offsets(None, {"t.b": 1}) == {"t.b": {"0": -2}} and handover.starting_offsets(held) == {}
    options = broker_options("h:1", ["a", "b"], "t", starting=begin)
    assert options["startingOffsets"] == '{"t.a": {"0": 10, "1": 5, "2": -2}, "t.b": {"0": -2}}'
    assert broker_options("h:1", starting={})["startingOffsets"] == "earliest"


def test_metrics_of_batches(spark, record, dimension, tmp_path):
    table, metrics = str(tmp_path / "table"), str(tmp_path / "metrics")
    sink = flows.metered(flows.measurement_sink(table, owner="s"), metrics)
    rows = flows.realtime(sent(record, 0, 15).unionByName(record([(None, "broken", "2024-01-01 09:00:00")])), dimension)
    for _ in range(2):
        sink(rows, 0)
    sink(rows.limit(0), 1)
    found = jobs.read_metrics(spark, metrics).orderBy("batch_id").collect()
    # Cities "b": messages 0, 7 and 14.
    assert [tuple(row)[:4] for row in found] == [(16, 1, 1, 3), (0, 0, 0, 0)]
    assert (found[0].first_time, found[0].last_time) == (at("2024-01-01 16:00:00"), at("2024-01-01 18:38:00"))
    assert found[1].first_time is None and jobs.read_measurements(spark, table).count() == 16
