"""K-d tree sharding by weighted medians.

The rows are points: a number per metadata dimension, and the row's size as its weight. Starting from one node
that holds all rows, every node with more than one shard is split along its widest dimension at the weighted
median (or the share of its lower shards), until each node is one shard of the target size. All nodes of a level
are split together, and a split point is found by narrowing histograms: each pass adds up the weights of at most
``BUCKETS`` buckets per node, and only these sums reach the driver. Rows with equal coordinates are told apart
by doc_id, and those that are equal in it too by their number in the table that holds the points, so a value that
a third of all rows share is split as any other.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from breathline.llm.base import kept

BUCKETS = 2048
# A split point may miss its share by this part of a shard's target size; it is exact to a row below that.
TOLERANCE = 0.0005
# The largest value of a coordinate; a place may lie one after it.
MOST = (1 << 63) - 1
# What tells rows with one value of a coordinate apart, and rows with one doc_id.
ID, ROW = "_id", "_row"


@dataclass
class Node:
    number: int
    first: int
    shards: int


@dataclass
class Search:
    """The place of one node's split: rows below ``low`` on ``axis`` go left, rows from ``high`` on go right,
    and ``wanted`` is the weight to take from those between. Once one value is left, it is ``fixed``, and doc_id is the
    axis, from the smallest to the largest doc_id of the rows with that value; then the number of the row likewise."""

    node: Node
    axis: str
    low: int
    high: int
    wanted: float
    slack: float
    fixed: tuple[tuple[str, int], ...] = ()
    cut: tuple[str, int, tuple[tuple[str, int], ...]] | None = None


def coded(column: Column) -> Column:
    """Text as a number in the order of its first seven bytes; null counts as empty."""
    start = F.rpad(F.substring(F.hex(F.encode(F.coalesce(column, F.lit("")), "UTF-8")), 1, 14), 14, "0")
    return F.conv(start, 16, 10).cast("long")


def kd_shards(
    points: DataFrame, dimensions: list[str], shards: int | None = None, target_bytes: int | None = None
) -> DataFrame:
    """Adds ``shard`` (from 0) and ``slot`` (gapless from 0 in its shard) to rows that have ``doc_id``, ``size``
    (weight, at least 1) and the numeric ``dimensions`` (nulls count as 0).

    The number of shards is given, or is the total size over ``target_bytes``, rounded up. A table with fewer
    rows than shards leaves shards empty, an empty table gives no rows. Rows that are equal in every dimension are
    split by doc_id (a null one, which stays null, like 0), repeated rows and rows without a doc_id by their number.
    Columns named like the added ones are replaced; other columns stay.
    """
    rows = kept(
        points.withColumns({
            **{name: F.coalesce(F.col(name).cast("long"), F.lit(0)) for name in dimensions},
            ID: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), ROW: F.monotonically_increasing_id(),
        }),
        "shard-points",
    )
    axes = [*dimensions, ID]
    bounds = rows.agg(F.sum("size"), *[g(a) for a in axes for g in (F.min, F.max)]).first()
    total = bounds[0] or 0
    if shards is None:
        shards = max(1, math.ceil(total / target_bytes))
    extent = {a: (bounds[1 + 2 * i], bounds[2 + 2 * i]) for i, a in enumerate(axes)}
    placed = rows.withColumn("shard", F.lit(0))
    nodes = [Node(0, 0, shards)]
    while total and any(node.shards > 1 for node in nodes):
        placed, nodes = _split_level(placed, nodes, dimensions, extent, total / shards)
    return _slots(placed)


def _split_level(rows: DataFrame, nodes: list[Node], dimensions: list[str], extent: dict, target: float):
    """``shard`` holds the number of the row's node, which is its first shard."""
    axes = [*dimensions, ID]
    split = {node.number: node for node in nodes if node.shards > 1}
    ranges = (
        rows.where(F.col("shard").isin(list(split))).groupBy("shard")
        .agg(F.sum("size").alias("weight"), *[g(a).alias(f"{n}_{a}") for a in axes for n, g in (("lo", F.min), ("hi", F.max))])
        .collect()
    )
    searches = []
    for found in ranges:
        node = split[found["shard"]]
        widths = {a: (found[f"hi_{a}"] - found[f"lo_{a}"]) / max(1, extent[a][1] - extent[a][0]) for a in dimensions}
        axis = max(dimensions, key=lambda a: widths[a], default=ID)
        if not widths or widths[axis] == 0:
            axis = ID
        lower = node.shards // 2
        searches.append(Search(node, axis, found[f"lo_{axis}"], found[f"hi_{axis}"] + 1,
                               found["weight"] * lower / node.shards, TOLERANCE * target))
    pending = list(searches)
    while pending:
        pending = _narrowed(rows, pending)
    number = F.col("shard")
    for search in searches:
        axis, at, fixed = search.cut
        right = F.col(axis) >= F.lit(at) if at <= MOST else F.lit(False)
        for name, value in reversed(fixed):
            right = (F.col(name) > value) | ((F.col(name) == value) & right)
        upper = search.node.first + search.node.shards // 2
        number = F.when((F.col("shard") == search.node.number) & right, F.lit(upper)).otherwise(number)
    following = []
    for node in nodes:
        lower = node.shards // 2
        if lower:
            following.append(Node(node.first, node.first, lower))
            following.append(Node(node.first + lower, node.first + lower, node.shards - lower))
        else:
            following.append(node)
    return rows.withColumn("shard", number), following


def _narrowed(rows: DataFrame, searches: list[Search]) -> list[Search]:
    """One histogram pass over the nodes still searched; sets the cut of those that are done."""
    inside, bucket = F.lit(False), F.lit(None).cast("long")
    steps = {}
    for search in searches:
        base, step = search.low, max(1, -(-(search.high - search.low) // BUCKETS))
        offset, width = F.col(search.axis) - F.lit(base), step
        if search.high - 1 - search.low > MOST:
            # The offset would be no long: with an even base and step, halves fall into the same buckets.
            base, step = base - base % 2, step + step % 2
            offset, width = F.shiftright(search.axis, 1) - F.lit(base // 2), step // 2
        steps[search.node.number] = base, step
        here = (F.col("shard") == search.node.number) & F.col(search.axis).between(search.low, search.high - 1)
        for name, value in search.fixed:
            here = here & (F.col(name) == value)
        inside = inside | here
        bucket = F.when(here, F.call_function("div", offset, F.lit(width))).otherwise(bucket)
    sums = rows.where(inside).groupBy("shard", bucket.alias("bucket")).agg(
        F.sum("size").alias("weight"), F.count("*").alias("rows"),
        *[bound(axis).alias(f"{name}{axis}") for axis in (ID, ROW) for name, bound in (("first", F.min), ("last", F.max))],
    ).collect()
    left = []
    for search in searches:
        base, step = steps[search.node.number]
        mine = sorted(tuple(r)[1:] for r in sums if r["shard"] == search.node.number)
        before = 0
        for place, weight, count, *ends in mine:
            if before + weight >= search.wanted:
                break
            before += weight
        start, end = max(search.low, base + place * step), min(search.high, base + (place + 1) * step)
        short, over = search.wanted - before, before + weight - search.wanted
        whole = step == 1
        if min(short, over) <= search.slack or (whole and count == 1):
            at = start if short <= over else end
            search.cut = (search.axis, at, search.fixed)
        elif whole:
            search.fixed, search.wanted = (*search.fixed, (search.axis, start)), short
            search.axis, (first, last) = (ROW, ends[2:]) if search.axis == ID else (ID, ends[:2])
            search.low, search.high = first, last + 1
            left.append(search)
        else:
            search.low, search.high, search.wanted = start, end, short
            left.append(search)
    return left


def _slots(rows: DataFrame) -> DataFrame:
    """Numbers the rows of a shard without sorting a shard in one task: rows are dealt by doc_id (without one by
    their number) to buckets, counted, and numbered inside their bucket from where the earlier buckets end."""
    dealt_by = F.when(F.col("doc_id").isNull(), F.xxhash64(ROW)).otherwise(F.xxhash64(ID))
    dealt = rows.drop("slot").withColumn("_bucket", F.pmod(dealt_by, F.lit(256)).cast("int"))
    counts = dealt.groupBy("shard", "_bucket").agg(F.count("*").alias("_rows"))
    starts = counts.selectExpr(
        "shard", "_bucket",
        "sum(_rows) over (partition by shard order by _bucket rows between unbounded preceding and current row)"
        " - _rows as _start",
    )
    return (
        dealt.selectExpr("*", "row_number() over (partition by shard, _bucket order by _id, _row) as _number")
        .join(starts, ["shard", "_bucket"])
        .withColumn("slot", (F.col("_start") + F.col("_number") - 1).cast("long"))
        .drop("_bucket", "_rows", "_start", "_number", ID, ROW)
    )


def document_points(docs: DataFrame) -> DataFrame:
    """The coordinates of documents: language, source, length in characters; columns that are not there count
    as null. ``size`` is the text in UTF-8 bytes (null: none) plus 1."""

    def there(name: str) -> Column:
        return F.col(name).cast("string") if name in docs.columns else F.lit(None).cast("string")

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), coded(there("lang")).alias("lang"),
        coded(there("source")).alias("source"), F.length(text).cast("long").alias("length"),
    )
