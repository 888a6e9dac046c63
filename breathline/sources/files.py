"""File sources: city dimension, message folders and the raw archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from breathline.schema import ARCHIVE, ARCHIVE_STORED, DIMENSION, RECORD

ARCHIVE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line; fails if the file is missing. The declared schema keeps thresholds int."""
    return spark.read.schema(DIMENSION).json(path)


def stream_messages(
    spark: SparkSession, path: str, max_bytes: int | None = None, max_files: int | None = None
) -> DataFrame:
    """A folder of Parquet files with the broker's columns, read as a stream."""
    reader = spark.readStream.schema(RECORD)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes or bytes_per_trigger(spark))
    return reader.parquet(path)


def bytes_per_trigger(spark: SparkSession, waves: int = 4) -> int:
    """Input of one micro-batch: a few full waves of tasks, however large the cluster is."""
    split = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    ))
    return split * waves * spark.sparkContext.defaultParallelism


def read_archive(spark: SparkSession, path: str, fmt: str = "json", where: Column | None = None) -> DataFrame:
    """The archive as rows. A ``where`` on city, year, month or day prunes folders."""
    reader = spark.read.schema(ARCHIVE)
    if fmt == "json":
        reader = reader.option("timestampFormat", ARCHIVE_TIME_FORMAT)
    rows = reader.format(fmt).load(path)
    return rows if where is None else rows.where(where)


def replay_archive(spark: SparkSession, path: str, fmt: str = "json", where: Column | None = None) -> DataFrame:
    """The archive as messages again, ready for the same parser as the live stream."""
    return _as_messages(read_archive(spark, path, fmt, where))


def stream_archive(
    spark: SparkSession, path: str, fmt: str = "json", max_bytes: int | None = None, max_files: int | None = None
) -> DataFrame:
    """The same as a stream, in bounded batches: a restart goes on with the files its checkpoint has not seen."""
    reader = spark.readStream.schema(ARCHIVE_STORED)
    if fmt == "json":
        reader = reader.option("timestampFormat", ARCHIVE_TIME_FORMAT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes or bytes_per_trigger(spark))
    return _as_messages(reader.format(fmt).load(path))


def _as_messages(archived: DataFrame) -> DataFrame:
    return archived.select(
        F.col("city").cast("binary").alias("key"),
        F.col("json_data").cast("binary").alias("value"),
        "topic",
        "partition",
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )
