"""Small files of closed partitions into few of a good size.

Streams write a folder per micro-batch below each partition (``tables.OWNER``). Compaction reads the folders of
the partitions that have too many files, writes their rows once more beside the table, and puts the new folder in
the place of the old ones. What it is about to do is written down before it touches the table, so a run that dies
is completed by the next one, and folders that arrive meanwhile are left alone.
"""

from __future__ import annotations

import json
import warnings
from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from breathline import workspace
from breathline.sinks.tables import OWNER, write_partitioned

COMPACTED = "compacted"
MANIFEST = "MANIFEST"
TARGET_BYTES = 128 << 20


def owner_folders(spark: SparkSession, path: str, partition_by: Sequence[str]) -> dict[str, dict[str, list[int]]]:
    """Sizes of the files in each owner's folder, by partition. One listing of names and sizes, of no rows."""
    found: dict[str, dict[str, list[int]]] = defaultdict(lambda: defaultdict(list))
    depth = len(partition_by) + len(OWNER)
    for name, size in workspace.files_at(spark, path, depth):
        parts = name.split("/")
        if not parts[-1].startswith(("_", ".")):
            found["/".join(parts[:len(partition_by)])]["/".join(parts[:depth])].append(size)
    return found


def _crowded(folders: dict[str, list[int]], target_bytes: int) -> bool:
    """Whether fewer files of the target size would do."""
    sizes = [size for some in folders.values() for size in some]
    return len(sizes) > 1 + sum(sizes) // target_bytes


def compact(
    spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str], sort_by: Sequence[str],
    closed: Callable[[str], bool], target_bytes: int = TARGET_BYTES, fmt: str = "parquet",
    options: dict[str, str] | None = None, fold: Callable[[DataFrame], DataFrame] | None = None,
) -> list[str]:
    """Compacts the partitions for which ``closed`` says, by their folder (``date=2024-05-01``), that no batch will be
    repeated in them any more. Returns those it has rewritten.

    All of them are one job. Rows are gathered by partition with the rebalance hint, which cuts a partition into
    files of the target size, so one that holds most of the rows is several tasks. ``fold`` may bring the rows down
    to fewer with the same meaning; it sees all rows of a partition. One run at a time per table.
    """
    finish_compaction(spark, path)
    listed = owner_folders(spark, path, partition_by)
    chosen = {name: folders for name, folders in listed.items() if closed(name) and _crowded(folders, target_bytes)}
    if not chosen:
        return []
    runs = [
        int(folder.rsplit("=", 1)[1]) for folders in listed.values() for folder in folders
        if f"/{OWNER[0]}={COMPACTED}/" in f"/{folder}"
    ]
    run = max(runs, default=-1) + 1
    sources = [folder for folders in chosen.values() for folder in folders]
    rows = spark.read.schema(schema).options(**(options or {})).option("basePath", path).format(fmt).load(
        [f"{path}/{folder}" for folder in sources]
    )
    if fold:
        rows = fold(rows.drop(*OWNER))
    rows = rows.withColumns({OWNER[0]: F.lit(COMPACTED), OWNER[1]: F.lit(run).cast("long")})
    beside = _beside(spark, path)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size, None)
    spark.conf.set(size, str(target_bytes))
    try:
        write_partitioned(rows, f"{beside}/rows", [*partition_by, *OWNER], sort_by, mode="overwrite", fmt=fmt, options=options)
    finally:
        spark.conf.set(size, before) if before is not None else spark.conf.unset(size)
    made = sorted(folder for folders in owner_folders(spark, f"{beside}/rows", partition_by).values() for folder in folders)
    if made != sorted(f"{name}/{OWNER[0]}={COMPACTED}/{OWNER[1]}={run}" for name in chosen):
        workspace.remove(spark, beside)
        raise ValueError(f"{path}: rows do not come back to the folders they are in; do types of the schema spell them anew?")
    workspace.write_text(spark, f"{beside}/{MANIFEST}", json.dumps({"made": made, "sources": sources}))
    _publish(spark, path)
    return sorted(chosen)


def _beside(spark: SparkSession, path: str) -> str:
    return workspace.pending(spark, path).removesuffix(".pending") + ".compaction"


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Completes a run that died after its plan was written; what a run left that died before is dropped."""
    beside = _beside(spark, path)
    if workspace.exists(spark, f"{beside}/{MANIFEST}"):
        _publish(spark, path)
    elif workspace.exists(spark, beside):
        warnings.warn(f"{path}: a compaction ended before its rows were complete; they are dropped", stacklevel=2)
        workspace.remove(spark, beside)


def _publish(spark: SparkSession, path: str) -> None:
    """Moves the new folders in and deletes the old ones. Each step may have been done before. A partition whose
    sources are gone has its new folder, so at no time is a row nowhere; between the two steps of a partition a
    reader can meet rows twice."""
    beside = _beside(spark, path)
    plan = json.loads(workspace.read_text(spark, f"{beside}/{MANIFEST}"))
    by_partition = defaultdict(list)
    for source in plan["sources"]:
        by_partition[source.rsplit("/", len(OWNER))[0]].append(source)
    for made in plan["made"]:
        workspace.move(spark, f"{beside}/rows/{made}", f"{path}/{made}")
        for source in by_partition[made.rsplit("/", len(OWNER))[0]]:
            workspace.remove(spark, f"{path}/{source}")
            workspace.remove_empty(spark, f"{path}/{source.rsplit('/', 1)[0]}")
    workspace.remove(spark, beside)
