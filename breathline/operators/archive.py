"""Raw archive by city and date of the message."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from breathline.functions.clock import date_parts
from breathline.functions.names import city_of
from breathline.sinks.tables import OWNER, owned, write_partitioned
from breathline.sources.files import ARCHIVE_TIME_FORMAT

FOLDERS = ["city", "year", "month", "day"]

OPTIONS = {"json": {"timestampFormat": ARCHIVE_TIME_FORMAT}, "parquet": {"compression": "snappy"}}


def archive_rows(records: DataFrame) -> DataFrame:
    """Raw text, time and id of each message, filed under its own date, not that of the batch."""
    return records.select(
        F.col("value").cast("string").alias("json_data"),
        F.col("timestamp").alias("kafka_timestamp"),
        "topic",
        "partition",
        F.col("offset").alias("kafka_offset"),
        city_of(F.col("key"), F.col("topic")).alias("city"),
        *[part.alias(name) for name, part in date_parts(F.col("timestamp")).items()],
    )


def write_archive(records: DataFrame, path: str, fmt: str = "json", batch_id: int = 0, owner: str | None = None) -> None:
    """``json``: one object per line, the message kept as a string, so any text survives unchanged.
    ``parquet``: the same columns, Snappy-compressed. Below its date a message lies in the folder of the stream
    and batch that brought it, so a repeated batch replaces its own files and nothing else."""
    write_partitioned(
        owned(archive_rows(records), batch_id, owner), path, [*FOLDERS, *OWNER], ["partition", "kafka_offset"],
        mode="overwrite", dynamic=True, fmt=fmt, options=OPTIONS[fmt],
    )


def bundle(records: DataFrame, messages_per_object: int = 1000, prefix: str = "archive") -> DataFrame:
    """JSON arrays of raw messages, one per city, date and block of consecutive offsets.

    A block holds at most ``messages_per_object`` messages, so no group grows with the city, and the same
    messages always make the same object. Copies of a message collapse as they are gathered, before the
    shuffle too, so that many copies do not make a large group either.
    """
    block = F.floor(F.col("kafka_offset") / F.lit(messages_per_object)).alias("block")
    entry = F.struct("kafka_offset", "json_data")
    in_order = F.array_sort(F.col("entries"))
    grouped = archive_rows(records).groupBy(*FOLDERS, "topic", "partition", block).agg(
        F.collect_set(entry).alias("entries"),
        F.min("kafka_offset").alias("first_offset"),
        F.max("kafka_offset").alias("last_offset"),
    )
    folder = F.concat_ws("/", F.lit(prefix), *FOLDERS)
    # Two topics may carry the same city; their blocks are told apart by the topic.
    name = F.format_string("batch_%s_%d_%d.json", "topic", "partition", "block")
    return grouped.select(
        F.concat_ws("/", folder, name).alias("object_key"),
        *FOLDERS,
        F.size("entries").alias("messages"),
        "first_offset",
        "last_offset",
        F.to_json(in_order.getField("json_data")).alias("body"),
    )


def write_bundles(records: DataFrame, path: str, messages_per_object: int = 1000) -> None:
    """Each bundle, one JSON array, in the folder of its object key below ``path``. Writing the same messages
    again replaces the same folders; objects of other messages stay."""
    name = F.substring_index("object_key", "/", -1).alias("object")
    rows = bundle(records, messages_per_object).select(*FOLDERS, name, "body")
    rows = rows.hint("rebalance", *FOLDERS).sortWithinPartitions(*FOLDERS, "object")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*FOLDERS, "object").text(path)
