"""Relational source and sink through Spark's JDBC data source (the driver jar is the cluster's)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession


def time_slices(column: str, bounds: Sequence[datetime]) -> list[str]:
    """Predicates, one per read task, that together cover every row once, missing times included."""
    cuts = [f"TIMESTAMP '{bound:%Y-%m-%d %H:%M:%S}'" for bound in sorted(set(bounds))]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def read_table(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], time_column: str, bounds: Sequence[datetime]
) -> DataFrame:
    """One task per time slice. A select or filter on the result is pushed to the database."""
    return spark.read.jdbc(url, table, predicates=time_slices(time_column, bounds), properties=properties)


def append_options(connections: int, batch_size: int = 10_000, isolation: str | None = None) -> dict[str, str]:
    """``connections`` bounds the tasks that write at once; rows go in batches. A task's rows are one transaction
    of Spark's default level; ``isolation`` "NONE" does without, which suits a staging table that is dropped."""
    options = {"numPartitions": str(connections), "batchsize": str(batch_size)}
    return options if isolation is None else {**options, "isolationLevel": isolation}


def append_table(
    df: DataFrame, url: str, table: str, properties: dict[str, str], connections: int = 16, isolation: str | None = None
) -> None:
    df.write.jdbc(
        url, table, mode="append", properties={**properties, **append_options(connections, isolation=isolation)}
    )


def append_batch(url: str, table: str, properties: dict[str, str], connections: int = 16):
    """``foreachBatch`` function. Delivery is at least once: keep the message id and drop replays on read."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_table(batch, url, table, properties, connections)

    return write
