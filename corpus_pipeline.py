"""From raw documents to packed sequences, stage by stage; each stage is written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from breathline import workspace
from breathline.llm import exact, jaccard, packing, secret_scan, toxicity
from breathline.llm.base import shipped, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; labels of the training folds alone are learnt from."""
    return toxicity.drop_toxic(docs, table(shipped(spark), sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text the smallest doc_id stays."""
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles, at 0.8 or more, the smallest doc_id stays."""
    shipped(spark)
    return jaccard.drop_near_copies(docs, width=5, shared=8, of=10)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced by a mark."""
    return secret_scan.redact(docs, secret_scan.labelled_findings(docs))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 2048."""
    shipped(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.digest(packing.pack(docs, path, public_tokenizers.PATTERN))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack_windows),
]

# A trained model and a tokenizer decide rows, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = workspace.scratch(spark, f"pipeline-{name}")
        made = stage(spark, docs, sf_dir)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
