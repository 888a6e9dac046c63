"""Tables laid out by several keys at once, and scans that open only the files they need.

A table sorted by one key serves filters on that key alone. Here rows are ordered by the interleaved bits of all
keys' codes, so that a file covers a small range of each. Beside the files lies a table of their zones, the least
and greatest value of each key in each file: a scan asks it which files to open, rather than opening the footer of
every file. Text keys get bloom filters, which rule out row groups for a value between a zone's ends.

A table is a row of generations, the highest complete one being the table. A run that dies leaves one that is not
complete, which the next run removes; readers of the generation before keep their files until the run after.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, DateType, StringType, StructType, TimestampNTZType, TimestampType

from breathline import workspace

READY = "READY"

# Bits of each key's code, and rows of the sample that the codes' bounds are taken from. The sample decides only
# where rows lie, never which.
BITS = 6
SAMPLE = 20_000


def _ordered(name: str, kind: DataType) -> Column:
    """The key as a value that Python and Spark order alike."""
    if isinstance(kind, TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, TimestampNTZType):
        return F.unix_micros(F.col(name).cast("timestamp"))
    return F.unix_date(name) if isinstance(kind, DateType) else F.col(name)


def _bounds(values: list, bits: int) -> list[tuple[Any, int]]:
    """Values at which the code rises, and the code from there on. Codes hold about as many rows each; a value
    that many rows share takes the codes of all of them, and rows of it the last."""
    values, codes = sorted(value for value in values if value is not None and value == value), 1 << bits
    risen: dict[Any, int] = {}
    for code in range(1, codes):
        if values:
            risen[values[code * len(values) // codes]] = code
    return list(risen.items())


def _code(value: Column, bounds: list[tuple[Any, int]]) -> Column:
    """The code by bisection, as nested conditions. Nulls have the lowest."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(bounds[low - 1][1] if low else 0)
        middle = (low + high) // 2
        return F.when(value < F.lit(bounds[middle][0]), between(low, middle)).otherwise(between(middle + 1, high))

    return F.when(value.isNull(), F.lit(0)).otherwise(between(0, len(bounds)))


def interleaved(codes: Sequence[Column], bits: int) -> Column:
    """Bits of all codes by turns, the first code's first."""
    turned = F.lit(0).cast("bigint")
    for bit in range(bits):
        for at, code in enumerate(codes):
            place = bit * len(codes) + len(codes) - 1 - at
            one = F.shiftright(code, bit).bitwiseAND(F.lit(1)).cast("bigint")
            turned = turned.bitwiseOR(F.shiftleft(one, place))
    return turned


def curve(rows: DataFrame, keys: Sequence[str], bits: int = BITS, sample: int = SAMPLE) -> Column:
    """The place of a row on the curve through all keys. Takes a count of the rows and a sample of their keys, of
    about ``sample`` rows whatever the table's size."""
    if bits * len(keys) > 62:
        raise ValueError(f"{len(keys)} keys of {bits} bits do not fit into a long")
    kinds = {name: rows.schema[name].dataType for name in keys}
    values = rows.select(*[_ordered(name, kinds[name]).alias(name) for name in keys])
    total = rows.count()
    if total > sample:
        values = values.sample(sample / total, seed=7)
    drawn = values.collect()
    codes = [
        _code(_ordered(name, kinds[name]), _bounds([row[at] for row in drawn], bits)) for at, name in enumerate(keys)
    ]
    return interleaved(codes, bits)


def _generations(spark: SparkSession, path: str) -> list[int]:
    if not workspace.exists(spark, path):
        return []
    return sorted(int(name[1:]) for name in workspace.folders(spark, path) if name[:1] == "g" and name[1:].isdigit())


def _complete(spark: SparkSession, path: str) -> list[int]:
    return [one for one in _generations(spark, path) if workspace.exists(spark, f"{path}/g{one}/{READY}")]


def write_clustered(
    rows: DataFrame, path: str, keys: Sequence[str], files: int, bits: int = BITS, sample: int = SAMPLE
) -> None:
    """Writes the rows as the table's next generation, in about ``files`` files.

    One shuffle, by ranges of the curve. Rows of one place on it are dealt by their keys and then by a hash of the
    whole row, so a value that a third of all rows share, or a missing one, is spread over a third of the files.
    The rows are computed for the count, for the sample and for the write: hand over a table's. An empty table has
    no files and no zones. One run at a time per table.
    """
    spark = rows.sparkSession
    complete = _complete(spark, path)
    for one in _generations(spark, path):
        if one not in complete[-1:]:
            workspace.remove(spark, f"{path}/g{one}")
    made = f"{path}/g{max(complete, default=0) + 1}"
    place = curve(rows, keys, bits, sample)
    texts = [name for name in keys if isinstance(rows.schema[name].dataType, StringType)]
    spread = rows.repartitionByRange(max(files, 1), place, *keys, F.xxhash64(*rows.columns))
    writer = spread.sortWithinPartitions(*keys).write
    for name in texts:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.parquet(f"{made}/rows")
    read = spark.read.schema(rows.schema).parquet(f"{made}/rows")
    limits = [
        find(name).alias(f"{name}_{end}") for name in keys for end, find in (("least", F.min), ("greatest", F.max))
    ]
    zones = read.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("rows"), *limits)
    zones.write.parquet(f"{made}/zones")
    workspace.mark(spark, f"{made}/{READY}")


def zones(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: file, rows, and for each key the least and greatest value that is not null."""
    return spark.read.parquet(f"{_newest(spark, path)}/zones")


def _newest(spark: SparkSession, path: str) -> str:
    complete = _complete(spark, path)
    if not complete:
        raise ValueError(f"{path}: no complete table")
    return f"{path}/g{complete[-1]}"


def _within(bounds: dict[str, tuple[Any, Any]], least: str = "{}", greatest: str = "{}") -> Column:
    held = F.lit(True)
    for name, (low, high) in bounds.items():
        if low is not None:
            held &= F.col(greatest.format(name)) >= F.lit(low)
        if high is not None:
            held &= F.col(least.format(name)) <= F.lit(high)
    return held


def files_within(spark: SparkSession, path: str, bounds: dict[str, tuple[Any, Any]]) -> list[str]:
    """Names of the files that can hold rows within the bounds."""
    wanted = zones(spark, path).where(_within(bounds, "{}_least", "{}_greatest"))
    return sorted(row["file"] for row in wanted.select("file").collect())


def read_clustered(
    spark: SparkSession, path: str, schema: StructType, bounds: dict[str, tuple[Any, Any]] | None = None
) -> DataFrame:
    """The rows whose keys lie within ``bounds``, from the least to the greatest value, both included; None leaves
    an end open. A bounded key that is null is outside, unless both of its ends are open. Without bounds, all rows.

    Only names of files reach the driver, and only of those that can hold such a row; their row groups and pages are
    skipped by the same filter.
    """
    bounds = {name: ends for name, ends in (bounds or {}).items() if ends != (None, None)}
    folder = f"{_newest(spark, path)}/rows"
    reader = spark.read.schema(schema)
    if not bounds:
        return reader.parquet(folder)
    chosen = files_within(spark, path, bounds)
    if not chosen:
        return spark.createDataFrame([], schema)
    return reader.parquet(*[f"{folder}/{name}" for name in chosen]).where(_within(bounds))


def files_for(total_bytes: int, target_bytes: int) -> int:
    return max(1, math.ceil(total_bytes / target_bytes))
