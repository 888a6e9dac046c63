"""Messages that a table already holds, told by intervals of offsets.

Offsets of a topic partition are consecutive, so what has been stored is a few intervals, however many messages
they cover. A replay is compared with these: messages are neither shuffled nor sorted, and only ids are read of
what is stored.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from breathline.operators.enrich import MAX_BROADCAST_ROWS, sized
from breathline.schema import RECORD_ID

# Offsets of one block: a topic partition that holds most messages is many blocks.
BLOCK = 1 << 20

# Blocks that short intervals are filed under, so that few of them share one, however sparse the offsets are.
SHORT_BLOCKS = [1 << 7, 1 << 14]

SOURCE = ["topic", "partition"]


def _block(offset: Column, block: int) -> Column:
    """Whole division of longs, as a quotient of doubles would lose the last digits of large offsets."""
    return F.call_function("div", offset, F.lit(block).cast("long"))


def _runs(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with ``first`` and ``last`` (of one key, they may overlap or touch), those that do joined, within each key."""
    order = Window.partitionBy(*keys).orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.coalesce(F.col("first") > reach + 1, F.lit(True)), 1).otherwise(0)
    numbered = rows.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("run")


def _across(runs: DataFrame, block: int) -> DataFrame:
    """Runs within blocks, those that touch over the bounds of blocks joined. Only runs at such a bound can: two a block, which
    meet by topic partition; every other run is a key of its own."""
    size = F.lit(block).cast("long")
    inside = (F.col("first") % size != 0) & (F.col("last") % size != size - 1)
    marked = runs.select(*SOURCE, "first", "last", F.when(inside, F.col("first")).alias("alone"))
    return _runs(marked, [*SOURCE, "alone"]).select(*SOURCE, "first", "last")


def offset_intervals(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """topic, partition, first, last: the offsets of the rows as intervals, apart by at least one offset.

    Offsets are not negative. They first meet in blocks of ``block`` consecutive ones, copies folded in each split before; only the runs of
    blocks meet by topic partition. Rows without a whole message id have no part in it.
    """
    offset = F.col("offset")
    ids = rows.select(*RECORD_ID).dropna().distinct()
    # Within a block, the offset less its place among the others is the same all along a run.
    blocked = ids.withColumn("block", _block(offset, block))
    place = F.row_number().over(Window.partitionBy(*SOURCE, "block").orderBy("offset"))
    runs = blocked.withColumn("run", offset - place).groupBy(*SOURCE, "block", "run").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last")
    )
    return _across(runs, block)


def _cut(intervals: DataFrame, block: int) -> DataFrame:
    """Intervals cut at blocks, with the number of the block."""
    size = F.lit(block).cast("long")
    low, high = _block(F.col("first"), block), _block(F.col("last"), block)
    pieces = intervals.select(*SOURCE, "first", "last", high.alias("high"), F.explode(F.sequence(low, high)).alias("block"))
    return pieces.select(
        *SOURCE, "block", F.greatest("first", F.col("block") * size).alias("first"),
        F.when(F.col("block") == F.col("high"), F.col("last")).otherwise(F.col("block") * size + (size - 1)).alias("last"),
    )


def merge_intervals(*sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Sets of intervals as one; intervals of different sets may overlap or touch. They meet in blocks, as offsets do."""
    rows = reduce(DataFrame.unionByName, [one.select(*SOURCE, "first", "last") for one in sets])
    return _across(_runs(_cut(rows, block), [*SOURCE, "block"]), block)


def _filed(intervals: DataFrame, block: int) -> list[tuple[int, DataFrame]]:
    """Sizes of blocks and what is filed under them: each interval once, under the smallest that is no less than its own (the
    largest, ``block``, if none is), with the number of each block it meets, at most two but of the largest size. Intervals
    that do not overlap are so at most some 130 to a block."""
    low, found, beyond = 0, [], F.col("last") - F.col("first")
    for size in [*[short for short in SHORT_BLOCKS if short < block], block]:
        filed = intervals.where((beyond >= low) & ((beyond < size) if size < block else F.lit(True)))
        number = F.explode(F.sequence(_block(F.col("first"), size), _block(F.col("last"), size)))
        found.append((size, filed.select(
            F.col("topic").alias("held_topic"), F.col("partition").alias("held_partition"), number.alias("held_block"),
            F.col("first").alias("held_first"), F.col("last").alias("held_last"),
        )))
        low = size
    return found


def not_within(
    rows: DataFrame, intervals: DataFrame, block: int = BLOCK, max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """The rows whose message lies in none of the intervals; a row without a whole message id always stays.

    Intervals are cut at blocks, so that the join has a key beside the topic partition, and short ones at small blocks: a row
    is held against those of its block alone, of which sparse offsets would leave very many in a large one.
    Up to ``max_rows`` pieces of a size are broadcast and the rows stay where they are; beyond, both sides are shuffled by block.
    """
    for size, pieces in _filed(intervals, block):
        within = [
            F.col("topic") == F.col("held_topic"), F.col("partition") == F.col("held_partition"),
            _block(F.col("offset"), size) == F.col("held_block"), F.col("offset") >= F.col("held_first"),
            F.col("offset") <= F.col("held_last"),
        ]
        rows = rows.join(sized(pieces, max_rows), reduce(and_, within), "left_anti")
    return rows
