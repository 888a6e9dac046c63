"""Session settings. Jobs receive a session and never stop it: several streams may share it."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Needed for right results and prunable files; set on any session the engine is handed.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    # INT96 timestamps carry no usable row-group statistics, so time filters would not prune.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Recommended at submit time; sizes of executors and shuffle partitions belong to the cluster.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def builder(app_name: str) -> SparkSession.Builder:
    made = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED, **RUNTIME}.items():
        made = made.config(key, value)
    return made
