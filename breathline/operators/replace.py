"""Replace-by-key on partitioned Parquet tables."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from breathline import workspace
from breathline.sinks.tables import write_partitioned

# Written beside a table once both copies are complete. Spark's own _SUCCESS may be switched off.
READY = "READY"


def _renamed(new: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """Keys of the new rows under names of their own, and the match condition against a table's rows."""
    fresh = new.select(*[F.col(key).alias(f"new_{key}") for key in keys])
    return fresh, reduce(and_, [F.col(key).eqNullSafe(F.col(f"new_{key}")) for key in keys])


def overlap_keys(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the target that the new rows replace."""
    return target.select(*keys).join(*_renamed(new, keys), "left_semi")


def survivors(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the target whose key the new rows do not have."""
    return target.join(*_renamed(new, keys), "left_anti")


def replaced(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after replacement, as a plan: rows match by column name, missing keys match each other."""
    return survivors(target, new, keys).unionByName(new.select(*target.columns))


def _touched(rows: DataFrame, column: str) -> list:
    """The driver sees one value per touched partition, and partitions are calendar days or months."""
    return [row[0] for row in rows.select(column).distinct().collect()]


def _in_partitions(values: list, column: str) -> Column:
    """Literal filter on partitions, so the scan of the target lists only them."""
    present = [value for value in values if value is not None]
    chosen = F.col(column).isin(present)
    return chosen if len(present) == len(values) else chosen | F.col(column).isNull()


def replace_by_key(
    spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], partition_by: str, sort_by: Sequence[str]
) -> list:
    """Deletes the rows of the table at ``path`` whose key occurs in ``new`` and adds ``new``. Returns the values
    of the partitions that were written.

    Only partitions that ``new`` touches are read and rewritten; ``partition_by`` must follow from the keys.
    New and surviving rows are first written beside the table and marked as complete, and the table is
    overwritten from those copies: a run that dies while overwriting is completed by the next one. One run at a
    time per table. ``new`` is computed once, and all further work is done in ``spark``. A key that occurs twice
    in ``new`` is an error, raised before the table is touched.
    """
    finish_pending(spark, path, new.schema, partition_by, sort_by)
    beside = workspace.pending(spark, path)
    new.write.mode("overwrite").parquet(f"{beside}/new")
    staged = spark.read.schema(new.schema).parquet(f"{beside}/new")
    values = _touched(staged, partition_by)
    if not values:
        workspace.remove(spark, beside)
        return values
    if not staged.groupBy(*keys).count().where("count > 1").isEmpty():
        workspace.remove(spark, beside)
        raise ValueError(f"several new rows have the same {', '.join(keys)}")
    kept = staged.where(F.lit(False))
    if workspace.exists(spark, path):
        touched = spark.read.schema(new.schema).parquet(path).where(_in_partitions(values, partition_by))
        kept = survivors(touched, staged, keys).select(*new.columns)
    kept.write.mode("overwrite").parquet(f"{beside}/kept")
    workspace.mark(spark, f"{beside}/{READY}")
    _publish(spark, path, new.schema, partition_by, sort_by)
    return values


def finish_pending(
    spark: SparkSession, path: str, schema: StructType, partition_by: str, sort_by: Sequence[str]
) -> None:
    """Completes a run that died: overwrites the touched partitions from the copies beside the table. Copies that
    were not complete belong to a run that failed before it touched the table; they are dropped, with a warning."""
    beside = workspace.pending(spark, path)
    if workspace.exists(spark, f"{beside}/{READY}"):
        _publish(spark, path, schema, partition_by, sort_by)
    elif workspace.exists(spark, beside):
        warnings.warn(f"{path}: a run ended before its rows were complete; they are dropped", stacklevel=2)
        workspace.remove(spark, beside)


def _publish(spark: SparkSession, path: str, schema: StructType, partition_by: str, sort_by: Sequence[str]) -> None:
    beside = workspace.pending(spark, path)
    rows = spark.read.schema(schema).parquet(f"{beside}/new", f"{beside}/kept")
    write_partitioned(rows, path, [partition_by], sort_by, mode="overwrite", dynamic=True)
    workspace.remove(spark, beside)
