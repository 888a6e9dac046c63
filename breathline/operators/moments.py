"""Hourly statistics from partial moments.

Every batch of readings appends one row per city and hour it holds: count, mean, squared deviations, extremes of
each quantity. Folding the rows of an hour gives its statistics, however its readings were dealt over batches. A
stream keeps no state for this, drops no late reading and rewrites nothing; the work of a batch follows its own
readings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from breathline.functions.clock import hour_start
from breathline.operators.rollup import HOURLY_KEYS, STATISTICS

PARTS = ["n", "mean", "m2", "min", "max"]

_KINDS = {"n": LongType(), "mean": DoubleType(), "m2": DoubleType()}


def _kind(name: str, part: str):
    return _KINDS.get(part) or (IntegerType() if name == "aqi" else DoubleType())


# One row per city, hour and batch; then the folders it is stored in.
MOMENTS = StructType([
    StructField("city", StringType()), StructField("hour_start", TimestampType()),
    *[StructField(f"{name}_{part}", _kind(name, part)) for name in STATISTICS for part in PARTS],
    StructField("records", LongType()),
])
STORED_MOMENTS = StructType([
    *MOMENTS, StructField("date", DateType()), StructField("stream", StringType()), StructField("batch_id", LongType()),
])


def partial_moments(measurements: DataFrame) -> DataFrame:
    """Moments of the readings given, by city and hour: fixed-width buffers, pre-aggregated in each split."""
    def of(name: str) -> list[Column]:
        value = F.col(name)
        made = {"n": F.count(value), "mean": F.avg(value), "m2": F.var_pop(value) * F.count(value), "min": F.min(value),
                "max": F.max(value)}
        return [made[part].alias(f"{name}_{part}") for part in PARTS]

    hour = hour_start(F.col("measurement_time")).alias("hour_start")
    return measurements.groupBy("city", hour).agg(
        *[column for name in STATISTICS for column in of(name)], F.count("*").alias("records")
    )


def _merged(left: Column, right: Column) -> Column:
    """Two sets of moments as one. Deviations are taken from means that lie beside each other, so no large squares
    cancel."""
    n = left["n"] + right["n"]
    apart = right["mean"] - left["mean"]
    both = F.struct(
        n.alias("n"),
        (left["mean"] + apart * right["n"] / n).alias("mean"),
        (left["m2"] + right["m2"] + apart * apart * left["n"] * right["n"] / n).alias("m2"),
    )
    return F.when(left["n"] == 0, right).when(right["n"] == 0, left).otherwise(both)


def _moments(name: str) -> Column:
    """The moments of a quantity in one row; without readings, none at a mean of 0."""
    return F.struct(
        F.col(f"{name}_n").alias("n"), F.coalesce(f"{name}_mean", F.lit(0.0)).alias("mean"),
        F.coalesce(f"{name}_m2", F.lit(0.0)).alias("m2"),
    )


def fold_moments(partials: DataFrame) -> DataFrame:
    """One row per city and hour of the same columns. What is gathered for an hour is one row per batch that held
    some of it, not its readings; compaction brings old hours down to one."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    gathered = partials.groupBy(*HOURLY_KEYS).agg(
        *[F.collect_list(_moments(name)).alias(name) for name in STATISTICS],
        *[F.min(f"{name}_min").alias(f"{name}_min") for name in STATISTICS],
        *[F.max(f"{name}_max").alias(f"{name}_max") for name in STATISTICS],
        F.sum("records").alias("records"),
    )
    folded = gathered.withColumns({name: F.aggregate(name, start, _merged) for name in STATISTICS})

    def of(name: str) -> list[Column]:
        some, inner = F.col(f"{name}.n") > 0, {"n": F.col(f"{name}.n")}
        inner |= {part: F.when(some, F.col(f"{name}.{part}")) for part in ("mean", "m2")}
        inner |= {part: F.col(f"{name}_{part}") for part in ("min", "max")}
        return [inner[part].alias(f"{name}_{part}") for part in PARTS]

    return folded.select(*HOURLY_KEYS, *[column for name in STATISTICS for column in of(name)], "records")


def hours_of(moments: DataFrame) -> DataFrame:
    """Folded moments as the rows of the hourly table."""
    made = {"avg": "{0}_mean", "max": "{0}_max", "min": "{0}_min"}

    def statistic(name: str, stat: str) -> Column:
        if stat == "stddev":
            return F.sqrt(F.col(f"{name}_m2") / F.col(f"{name}_n"))
        return F.col(made[stat].format(name))

    kept = [statistic(name, stat).alias(f"{name}_{stat}") for name, stats in STATISTICS.items() for stat in stats]
    return moments.select(*HOURLY_KEYS, *kept, F.col("records").cast("int").alias("record_count"))


def merge_tables(tables: list[DataFrame]) -> DataFrame:
    """Moments kept in several places, as one."""
    return fold_moments(reduce(DataFrame.unionByName, [table.select(*MOMENTS.names) for table in tables]))
