import random

import pytest
from pyspark.sql import functions as F
from rows import rows_of

from breathline.operators import intervals
from breathline.operators.archive import write_archive
from breathline.plans import jobs
from breathline.schema import DIMENSION

SCHEMA = "topic string, partition int, offset long, value string"


@pytest.fixture()
def messages(spark):
    draw = random.Random(8)
    rows = [(f"t{draw.randrange(2)}", draw.randrange(2), draw.randrange(400), "x") for _ in range(600)]
    rows += [("hot", 0, offset, "y") for offset in range(3000) if offset % 97] * 2
    rows += [("edge", 0, 0, "z"), ("edge", 0, (1 << 63) - 2, "z"), ("edge", 0, (1 << 63) - 3, "z"), ("edge", 0, (1 << 62) + 1, "z")]
    rows += [(None, 0, 5, "a"), ("t0", None, 5, "b"), ("t0", 0, None, "c"), ("t0", 0, None, "c")]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def expected(rows):
    ids = sorted({(r.topic, r.partition, r.offset) for r in rows if None not in (r.topic, r.partition, r.offset)})
    found = []
    for topic, partition, offset in ids:
        if found and found[-1][:2] == [topic, partition] and found[-1][3] == offset - 1:
            found[-1][3] = offset
        else:
            found.append([topic, partition, offset, offset])
    return sorted((tuple(one) for one in found), key=str)


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
def test_intervals(messages, block):
    assert rows_of(intervals.offset_intervals(messages, block)) == expected(messages.collect())


def test_sets_that_overlap_or_touch(messages):
    parts = [messages.where(condition) for condition in ("offset % 5 < 3", "offset % 7 < 4", "offset < 900")]
    merged = intervals.merge_intervals(*[intervals.offset_intervals(part) for part in parts])
    whole = messages.where("offset % 5 < 3 OR offset % 7 < 4 OR offset < 900")
    assert rows_of(merged) == expected(whole.collect())


@pytest.mark.parametrize("block, max_rows", [(10, 100_000), (10, 3), (1 << 20, 100_000)])
def test_only_messages_outside_stay(messages, block, max_rows):
    held = messages.where("offset % 400 < 250 AND topic <> 'edge'")
    known = {(r.topic, r.partition, r.offset) for r in held.dropna().collect()}
    left = intervals.not_within(messages, intervals.offset_intervals(held, block), block, max_rows)
    assert left.columns == messages.columns
    wanted = [tuple(r) for r in messages.collect() if (r.topic, r.partition, r.offset) not in known]
    assert sorted(map(tuple, left.collect()), key=str) == sorted(wanted, key=str)


def test_nothing_held_and_nothing_sent(spark, messages):
    none = spark.createDataFrame([], SCHEMA)
    held = intervals.offset_intervals(none)
    assert held.count() == 0 and intervals.not_within(messages, held).count() == messages.count()
    assert intervals.not_within(none, intervals.offset_intervals(messages.where("topic <> 'edge'"))).count() == 0


def test_texts_are_not_shuffled(spark, messages):
    held = spark.createDataFrame([("hot", 0, 0, 2000)], "topic string, partition int, first long, last long")
    plan = intervals.not_within(messages, held)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_replay_of_what_is_missing(spark, tmp_path, record):
    archive, table = str(tmp_path / "archive"), str(tmp_path / "table")
    sent = record([("hot", {"aqi": n}, "2024-01-01T10:00:00") for n in range(50)])
    dimension = spark.createDataFrame([("hot", "Hot", "VN", "North", 9, "x", 50, 100, 150, 200, 300)], DIMENSION)
    write_archive(sent, archive)
    where = F.col("kafka_offset") % 10 < 4
    jobs.run_replay(spark, archive, dimension, table, where=where, only_missing=True)
    assert jobs.read_measurements(spark, table).count() == 20
    for _ in range(2):
        jobs.run_replay(spark, archive, dimension, table, only_missing=True)
        assert rows_of(jobs.read_measurements(spark, table), "offset", "aqi") == sorted(((n, n) for n in range(50)), key=str)


def test_sparse_offsets_meet_few_to_a_block(spark):
    """Every second offset of one topic partition, and longer stretches beyond: no block has many of them."""
    far = 1 << 22
    held = spark.range(0, 100_000).selectExpr("2 * id AS first", "2 * id AS last").unionAll(
        spark.range(0, 500).selectExpr(f"{far} + 300 * id AS first", f"{far} + 300 * id + 200 AS last")
    ).selectExpr("'t' AS topic", "0 AS partition", "first", "last")
    filed = intervals._filed(held, intervals.BLOCK)
    for _, pieces in filed:
        most = pieces.groupBy("held_topic", "held_partition", "held_block").count().agg(F.max("count")).first()[0]
        assert (most or 0) <= 130
    assert sum(pieces.select("held_first").distinct().count() for _, pieces in filed) == 100_500
    rows = spark.range(0, 200_010).unionAll(spark.range(far, far + 150_000)).selectExpr("'t' AS topic", "0 AS partition", "id AS offset")
    for max_rows in (10, 1_000_000):
        left = intervals.not_within(rows, held, max_rows=max_rows)
        assert left.where(f"offset < {far}").count() == 100_010
        assert left.where(f"offset >= {far}").agg(F.count("*"), F.min(F.col("offset") % 300)).first()[0] == 150_000 - 500 * 201


def test_runs_apart_from_bounds_of_blocks_are_not_gathered(spark):
    """Only stretches at a block's bound meet by topic partition; the others are groups of their own."""
    rows = spark.range(0, 64).selectExpr("'t' AS topic", "0 AS partition", "2 * id AS offset").unionAll(
        spark.sql("SELECT 't' AS topic, 0 AS partition, explode(sequence(125L, 131L)) AS offset"))
    found = intervals.offset_intervals(rows, 16)
    assert rows_of(found.select("first", "last")) == sorted([(n, n) for n in range(0, 124, 2)] + [(124, 131)], key=str)
    assert "alone" in found._jdf.queryExecution().executedPlan().toString()
    again = intervals.merge_intervals(found, found.where("first < 50"), block=16)
    assert rows_of(again.select("first", "last")) == rows_of(found.select("first", "last"))
