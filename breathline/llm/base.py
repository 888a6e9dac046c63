"""What the operators share: the columns they read, ASCII words, and tables kept between steps."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import breathline
from breathline import workspace

SPACES = r"[\x20\x09-\x0D]+"


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` and whole ``text`` (null: empty); whatever else the table holds is left behind, so that no
    column of it can clash with a name that an operator uses."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )


def shipped(spark: SparkSession) -> SparkSession:
    """The session, once its executors have this package: the driver serves it to them as any Python file."""
    if not os.path.exists(SparkFiles.get("breathline.zip")):
        top = os.path.dirname(os.path.dirname(os.path.abspath(breathline.__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="breathline-"), "breathline")
        spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", top, "breathline"))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, label: str) -> DataFrame:
    """The rows, computed once and written to the folder that all executors share."""
    spark = df.sparkSession
    path = workspace.scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one space."""
    return F.regexp_replace(text, SPACES, " ")


def slices(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose ``column`` holds about ``size`` bytes; a longer row comes alone."""
    start, taken = 0, 0
    for row, value in enumerate(batch.column(column)):
        length = len(value.as_buffer()) if value.is_valid else 0
        if row > start and taken + length > size:
            yield batch.slice(start, row - start)
            start, taken = row, 0
        taken += length
    if batch.num_rows > start:
        yield batch.slice(start)


def ascii_words(text: str) -> list[bytes]:
    """Lower-cased A-Z, words between ASCII white space; other letters stay as they are."""
    return text.encode("utf-8", "surrogatepass").lower().split()
