"""Where jobs keep scratch tables, stream checkpoints and half-done replacements.

Everything lies below the folder the cluster names in ``spark.checkpoint.dir``, which every executor can
reach, so the loss of an executor or of the driver loses nothing that was written.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="breathline-")
        context.setCheckpointDir(named)
    return f"{named.rstrip('/')}/breathline"


def scratch(spark: SparkSession, label: str) -> str:
    """A new path for one run, removed when the driver ends."""
    path = f"{root(spark)}/{label}-{uuid.uuid4().hex}"
    filesystem, jvm_path = _resolve(spark, path)
    filesystem.mkdirs(jvm_path.getParent())
    filesystem.deleteOnExit(jvm_path)
    return path


def pending(spark: SparkSession, table_path: str) -> str:
    """The one path that belongs to a target table: beside it, however the table's path is written and whatever
    this session's folders are, so that a later driver finds it."""
    filesystem, jvm_path = _resolve(spark, table_path)
    table = filesystem.makeQualified(jvm_path)
    return f"{table.getParent()}/_{table.getName()}.pending"


def cut(df: DataFrame, label: str = "rows") -> DataFrame:
    """The rows, computed once and kept in the shared folder until the driver ends."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _resolve(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    filesystem, jvm_path = _resolve(spark, path)
    return filesystem.exists(jvm_path)


def mark(spark: SparkSession, path: str) -> None:
    """Creates an empty file."""
    filesystem, jvm_path = _resolve(spark, path)
    filesystem.create(jvm_path).close()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a path."""
    filesystem, jvm_path = _resolve(spark, path)
    return sorted(status.getPath().getName() for status in filesystem.listStatus(jvm_path) if status.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    filesystem, jvm_path = _resolve(spark, path)
    filesystem.delete(jvm_path, True)


def remove_empty(spark: SparkSession, path: str) -> None:
    """Removes a folder that has nothing in it."""
    filesystem, jvm_path = _resolve(spark, path)
    if filesystem.exists(jvm_path) and not filesystem.listStatus(jvm_path):
        filesystem.delete(jvm_path, False)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Gives a folder its new place; nothing to do if it is there already."""
    filesystem, jvm_source = _resolve(spark, source)
    _, jvm_target = _resolve(spark, target)
    if filesystem.exists(jvm_target) and not filesystem.exists(jvm_source):
        return
    filesystem.mkdirs(jvm_target.getParent())
    if not filesystem.rename(jvm_source, jvm_target):
        raise OSError(f"could not move {source} to {target}")


def files_at(spark: SparkSession, path: str, depth: int) -> list[tuple[str, int]]:
    """Names, from the path on, and sizes of the files that many folders below it."""
    filesystem, jvm_path = _resolve(spark, path)
    if not filesystem.exists(jvm_path):
        return []
    start = len(filesystem.makeQualified(jvm_path).toString().rstrip("/")) + 1
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/*" * (depth + 1))
    found = filesystem.globStatus(pattern)
    return [(one.getPath().toString()[start:], one.getLen()) for one in found if one.isFile()]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete under its name or not there."""
    filesystem, jvm_path = _resolve(spark, path)
    _, beside = _resolve(spark, path + ".part")
    stream = filesystem.create(beside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not filesystem.rename(beside, jvm_path):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    filesystem, jvm_path = _resolve(spark, path)
    stream = filesystem.open(jvm_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
