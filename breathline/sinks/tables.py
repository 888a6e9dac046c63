"""Partitioned table writes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

# Lowest folders of a table that streams write: the query, by the id kept in its checkpoint, and its batch.
OWNER = ["stream", "batch_id"]

# Owner of a batch that no stream has handed over.
DIRECT = "direct"


def stream_id(batch: DataFrame) -> str:
    """The query whose micro-batch this is. A restart from the same checkpoint has the same id; a new checkpoint,
    whose batch ids begin at 0 again, has another, as has any second stream into the same table."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or DIRECT


def owned(batch: DataFrame, batch_id: int, owner: str | None = None) -> DataFrame:
    """The rows with the folders of their batch. Writing these alone anew repeats or adds, and never takes away
    what another batch or stream has written."""
    return batch.withColumns({
        "stream": F.lit(owner or stream_id(batch)), "batch_id": F.lit(batch_id).cast("bigint"),
    })


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str],
    mode: str = "append",
    dynamic: bool = False,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    cluster: bool = True,
) -> None:
    """Writes one folder per partition value, rows sorted so that row groups can be skipped.

    ``cluster`` gathers each partition's rows first, to avoid a file per task and partition. The rebalance
    hint lets adaptive execution cut a partition that holds most of the rows into several tasks.
    """
    rows = df.hint("rebalance", *partition_by) if cluster else df
    rows = rows.sortWithinPartitions(*partition_by, *[name for name in sort_by if name not in partition_by])
    writer = rows.write.mode(mode).partitionBy(*partition_by).options(**(options or {}))
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.format(fmt).save(path)


def append_batch(
    path: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str],
    on_count: Callable[[int, int], None] | None = None,
    name: str | None = None,
    owner: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function. Each batch of each stream owns a folder below each partition and overwrites it,
    so a batch that is run again after a failure leaves no second copy (Spark repeats a batch with the time it
    first had). Row count and touched partitions are observed while writing, not recomputed; an empty batch
    writes no rows. ``name`` is the table's name in the catalog, if it is to have one."""

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"batch_{batch_id}")
        rows = owned(batch, batch_id, owner)
        folders = [*partition_by, *OWNER]
        observed = rows.observe(seen, F.count("*").alias("rows"), F.collect_set(F.struct(*folders)).alias("folders"))
        write_partitioned(observed, path, folders, sort_by, mode="overwrite", dynamic=True, cluster=False)
        if name:
            ensure_table(batch.sparkSession, name, rows.schema, folders, path, [tuple(row) for row in seen.get["folders"]])
        if on_count:
            on_count(batch_id, seen.get["rows"])

    return write


def _partition(names: Sequence[str], values: Sequence) -> str:
    said = ["null" if value is None else "'" + str(value).replace("'", "\\'") + "'" for value in values]
    return "PARTITION (" + ", ".join(f"`{name}` = {value}" for name, value in zip(names, said)) + ")"


def ensure_table(
    spark: SparkSession, name: str, schema: StructType, partition_by: Sequence[str], path: str,
    touched: Sequence[tuple] | None = None,
) -> bool:
    """Gives the files at ``path`` a name in the catalog if they have none, and tells the catalog the partitions
    that a write has ``touched``; without these, or for a new name, it lists the whole table. True if the name
    is new."""
    missing = not spark.catalog.tableExists(name)
    if missing:
        fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet "
            f"PARTITIONED BY ({', '.join(partition_by)}) LOCATION '{path}'"
        )
    if missing or touched is None:
        spark.catalog.recoverPartitions(name)
    elif touched:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(_partition(partition_by, one) for one in touched))
    return missing
