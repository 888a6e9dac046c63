import glob
import os

import pytest
from rows import rows_of
from pyspark.sql import functions as F

from breathline import workspace
from breathline.operators import replace
from breathline.sinks.tables import ensure_table, write_partitioned

SCHEMA = "city STRING, hour INT, value DOUBLE, day STRING"
KEYS = ["city", "hour"]


@pytest.fixture()
def path(tmp_path):
    return str(tmp_path / "table")


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def put(spark, path, *values):
    replace.replace_by_key(spark, path, rows(spark, *values), KEYS, "day", KEYS)


def stored(spark, path):
    return rows_of(spark.read.schema(SCHEMA).parquet(path), "city", "hour", "value", "day")


FIRST = [("a", 1, 1.0, "d1"), ("a", 2, 2.0, "d1"), ("b", 1, 3.0, "d1"), ("a", 30, 4.0, "d2"), (None, 1, 5.0, "d1")]
SECOND = [("a", 2, 20.0, "d1"), ("c", 7, 70.0, "d1"), (None, 1, 50.0, "d1"), ("z", 99, 9.0, "d9")]
AFTER = sorted([FIRST[0], FIRST[2], FIRST[3], *SECOND], key=str)


def test_replaces_adds_and_keeps(spark, path):
    put(spark, path, *FIRST)
    assert stored(spark, path) == sorted(FIRST, key=str)
    put(spark, path, *SECOND)
    assert stored(spark, path) == AFTER


def test_twice_is_once(spark, path):
    for values in (FIRST, SECOND, SECOND):
        put(spark, path, *values)
    assert stored(spark, path) == AFTER


def test_untouched_partitions_keep_their_files(spark, path):
    put(spark, path, *FIRST)
    before = {name: os.stat(name).st_mtime_ns for name in glob.glob(f"{path}/day=d2/*.parquet")}
    put(spark, path, *SECOND)
    assert before == {name: os.stat(name).st_mtime_ns for name in glob.glob(f"{path}/day=d2/*.parquet")}


def test_new_rows_match_by_name(spark, path):
    put(spark, path, *FIRST)
    turned = rows(spark, *SECOND).select("day", "value", "hour", "city")
    replace.replace_by_key(spark, path, turned, KEYS, "day", KEYS)
    assert stored(spark, path) == AFTER


def test_missing_partition_value(spark, path):
    put(spark, path, ("a", 1, 1.0, None), ("b", 1, 1.0, None), ("b", 2, 1.0, "d1"))
    put(spark, path, ("a", 1, 2.0, None))
    assert stored(spark, path) == [("a", 1, 2.0, None), ("b", 1, 1.0, None), ("b", 2, 1.0, "d1")]


def test_nothing_new_changes_nothing(spark, path):
    put(spark, path, *FIRST)
    replace.replace_by_key(spark, path, rows(spark, *FIRST).limit(0), KEYS, "day", KEYS)
    assert stored(spark, path) == sorted(FIRST, key=str)


@pytest.mark.parametrize("lost", [False, True])
def test_run_that_died_while_overwriting_is_completed(spark, path, monkeypatch, lost):
    """The worst moment: the old files of a touched partition may be gone, the new ones not yet in place."""
    put(spark, path, *FIRST)

    def die(*args, **kwargs):
        if lost:
            workspace.remove(spark, f"{path}/day=d1")
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(replace, "write_partitioned", die)
        with pytest.raises(RuntimeError):
            put(spark, path, *SECOND)
    put(spark, path, ("a", 30, 40.0, "d2"))
    assert stored(spark, path) == sorted(
        [row for row in AFTER if row[1] != 30] + [("a", 30, 40.0, "d2")], key=str
    )
    assert not workspace.exists(spark, workspace.pending(spark, path))


def test_run_that_died_before_both_copies_were_complete_is_forgotten(spark, path):
    put(spark, path, *FIRST)
    rows(spark, *SECOND).write.parquet(workspace.pending(spark, path) + "/new")
    with pytest.warns(UserWarning, match="ended before"):
        put(spark, path, ("a", 30, 40.0, "d2"))
    assert ("c", 7, 70.0, "d1") not in stored(spark, path) and len(stored(spark, path)) == len(FIRST)


def test_success_markers_may_be_off(spark, path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        put(spark, path, *FIRST)
        put(spark, path, *SECOND)
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert stored(spark, path) == AFTER


def test_pending_place_follows_from_the_table_alone(spark, path):
    place = workspace.pending(spark, path)
    assert workspace.pending(spark, path + "/") == workspace.pending(spark, "file:" + path) == place
    assert place.rsplit("/", 1)[0] == "file:" + os.path.dirname(path)


def test_two_new_rows_of_one_key_are_an_error(spark, path):
    put(spark, path, *FIRST)
    with pytest.raises(ValueError, match="city, hour"):
        put(spark, path, *SECOND, ("c", 7, 71.0, "d1"))
    assert stored(spark, path) == sorted(FIRST, key=str)
    put(spark, path, *SECOND)
    assert stored(spark, path) == AFTER


def test_touched_partitions_alone_are_added_to_the_catalog(spark, path):
    name = "touched_statistics"
    try:
        put(spark, path, *FIRST)
        schema = rows(spark, *FIRST).schema
        ensure_table(spark, name, schema, ["day"], path)
        put(spark, path, ("q", 1, 1.0, "d'7"), ("q", 2, 1.0, "d8"))
        ensure_table(spark, name, schema, ["day"], path, [("d'7",), ("d8",)])
        assert rows_of(spark.table(name).where("city = 'q'"), "day") == [("d'7",), ("d8",)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_overlap_and_plan_form(spark):
    old, new = rows(spark, *FIRST), rows(spark, *SECOND, *SECOND[:1])
    assert rows_of(replace.overlap_keys(old, new, KEYS)) == [("a", 2), (None, 1)]
    merged = replace.replaced(old, rows(spark, *SECOND), KEYS)
    assert rows_of(merged, "city", "hour", "value", "day") == AFTER
    same = old.where("hour < 3")
    assert replace.survivors(old, same, KEYS).count() == 1


def test_only_touched_partitions_are_listed(spark, path):
    put(spark, path, *FIRST)
    condition = replace._in_partitions(replace._touched(rows(spark, *SECOND), "day"), "day")
    plan = spark.read.schema(SCHEMA).parquet(path).where(condition)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day" in plan or "PartitionFilters: [(day" in plan or "INSET" in plan or "day#" in plan


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """One day with nearly all rows: the rebalance hint cuts it, so no task writes the whole day."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(0, 400_000, 1, 8).select(
            F.when(F.col("id") % 50 == 0, "cold").otherwise("hot").alias("day"), F.xxhash64("id").alias("value")
        )
        write_partitioned(df, str(tmp_path / "t"), ["day"], ["value"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{tmp_path}/t/day=hot/*.parquet")) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 400_000


def test_table_is_created_once(spark, path):
    put(spark, path, *FIRST)
    name = "hourly_statistics"
    schema = rows(spark, *FIRST).schema
    try:
        assert ensure_table(spark, name, schema, ["day"], path)
        assert not ensure_table(spark, name, schema, ["day"], path)
        assert spark.table(name).columns == schema.names
        assert rows_of(spark.table(name)) == sorted(FIRST, key=str)
        put(spark, path, *SECOND)
        ensure_table(spark, name, schema, ["day"], path)
        assert rows_of(spark.table(name)) == AFTER
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
