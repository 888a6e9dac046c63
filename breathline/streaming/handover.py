"""A replay of the archive that hands over to the live stream, as one job that may stop anywhere.

The archive is read as a checkpointed file stream until its end; then the live stream takes over, from the first offset
the archive lacks where the broker's partitions are known. Both store through one filter: what has been stored is told by
intervals of offsets, kept batch by batch beside the checkpoints, so a message that both hold is stored once.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from breathline import workspace
from breathline.operators.dedup import drop_replays
from breathline.operators.intervals import merge_intervals, not_within, offset_intervals
from breathline.schema import RECORD_ID
from breathline.streaming.run import Sink

# Names of the two phases, in their order: states sort by phase, then by batch.
ARCHIVE_PHASE, LIVE_PHASE = "archive", "live"

# The broker's word for the oldest message it has.
EARLIEST = -2


def _states(spark: SparkSession, held: str) -> list[str]:
    """Names of the states that were written whole, oldest first."""
    names = workspace.folders(spark, held) if workspace.exists(spark, held) else []
    return [name for name in names if workspace.exists(spark, f"{held}/{name}/_SUCCESS")]


def held_intervals(spark: SparkSession, held: str) -> DataFrame | None:
    """What the newest state says is stored; none before the first batch."""
    names = _states(spark, held)
    return spark.read.parquet(f"{held}/{names[-1]}") if names else None


def _messages(intervals: DataFrame | None) -> int:
    if intervals is None:
        return 0
    return intervals.agg(F.coalesce(F.sum(F.col("last") - F.col("first") + 1), F.lit(0))).first()[0]


def once_sink(write: Sink, held: str, phase: str) -> Sink:
    """``write`` with the messages of a batch that no earlier batch has stored, each once.

    A batch reads the state its predecessor left and writes its own before it stores rows. Only later batches read that,
    and they run after this one is done: a batch that is repeated finds the same predecessor, and stores the same rows.
    Message ids alone are gathered; rows are shuffled only in a batch that has copies within itself. Rows without
    a whole message id cannot be told to be copies: all of them are stored. A batch without new messages leaves no state.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark, own = batch.sparkSession, f"{phase}-{batch_id:012d}"
        earlier = [name for name in _states(spark, held) if name < own]
        before = spark.read.parquet(f"{held}/{earlier[-1]}") if earlier else None
        # Parsed and compared once, for the state and for the table.
        fresh = (batch if before is None else not_within(batch, before)).persist()
        try:
            if fresh.isEmpty():
                return
            seen = Observation(own)
            identified = reduce(and_, [F.col(name).isNotNull() for name in RECORD_ID])
            brought = offset_intervals(fresh.observe(seen, F.count_if(identified).alias("rows")))
            after = brought if before is None else merge_intervals(before, brought)
            after.write.mode("overwrite").parquet(f"{held}/{own}")
            # As many ids as rows that have one: no copies.
            added = _messages(spark.read.parquet(f"{held}/{own}")) - _messages(before)
            write(fresh if added == seen.get["rows"] else drop_replays(fresh), batch_id)
        finally:
            fresh.unpersist()
        for name in earlier[:-1]:
            workspace.remove(spark, f"{held}/{name}")

    return sink


def starting_offsets(held: DataFrame | None, partitions: Mapping[str, int] | None = None) -> dict[str, dict[str, int]]:
    """Per topic and partition the first offset after the oldest stretch that is held, in the form the broker's reader
    takes. It must name every partition of the topics it is given, so ``partitions`` says how many each has; those of
    which nothing is held begin at their oldest message. Messages held beyond that offset are left to the filter.
    Without ``partitions`` there is nothing to say, and the stream begins at the oldest message."""
    if not partitions:
        return {}
    begin = {topic: {str(number): EARLIEST for number in range(count)} for topic, count in partitions.items()}
    if held is not None:
        ends = held.groupBy("topic", "partition").agg(F.min_by("last", "first").alias("last"))
        for row in ends.where(F.col("topic").isin(*partitions)).collect():
            begin[row["topic"]][str(row["partition"])] = row["last"] + 1
    return begin
