"""Replayed messages: delivery is at least once, the message id tells copies apart."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from breathline.schema import RECORD_ID


def _identified() -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in RECORD_ID])


def drop_replays(rows: DataFrame) -> DataFrame:
    """One row per message. Copies collapse within each input split before the shuffle. Rows without a whole
    message id cannot be told to be copies: all of them stay."""
    alone = F.when(~_identified(), F.monotonically_increasing_id())
    return rows.withColumn("_alone", alone).dropDuplicates([*RECORD_ID, "_alone"]).drop("_alone")


def drop_replays_stream(rows: DataFrame, time: str, delay: str) -> DataFrame:
    """The same on a stream, with state for ``delay`` behind the newest message. A copy later than that is
    the batch form's business."""
    known, unknown = rows.where(_identified()), rows.where(~_identified())
    return known.withWatermark(time, delay).dropDuplicatesWithinWatermark(RECORD_ID).unionByName(
        unknown.withWatermark(time, delay)
    )
