"""Message stream: one subscription serves every city, and the city travels as a column."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from breathline.functions.names import TOPIC_PREFIX


@dataclass(frozen=True)
class Security:
    protocol: str = "PLAINTEXT"
    mechanism: str = "PLAIN"
    username: str = ""
    password: str = ""

    def options(self) -> dict[str, str]:
        if self.protocol == "PLAINTEXT":
            return {}
        user, secret = (text.replace("\\", "\\\\").replace('"', '\\"') for text in (self.username, self.password))
        return {
            "kafka.security.protocol": self.protocol,
            "kafka.sasl.mechanism": self.mechanism,
            # Fixed format of the login line.
            "kafka.sasl.jaas.config": "org.apache.kafka.common.security.plain.PlainLoginModule required "
                                      f'username="{user}" password="{secret}";',
        }


def broker_options(
    servers: str,
    cities: Sequence[str] | None = None,
    prefix: str = TOPIC_PREFIX,
    security: Security = Security(),
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    starting: Mapping[str, Mapping[str, int]] | None = None,
) -> dict[str, str]:
    """Reader options. ``min_partitions`` makes Spark split a topic partition that holds most of the
    backlog into several tasks; ``max_offsets_per_trigger`` bounds one micro-batch; ``starting`` names the first
    offset of every partition, which is the oldest one if left out. A checkpoint goes before both."""
    first = json.dumps(starting, sort_keys=True) if starting else "earliest"
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": first, **security.options()}
    if cities:
        options["subscribe"] = ",".join(f"{prefix}.{city}" for city in cities)
    else:
        options["subscribePattern"] = re.escape(prefix) + r"\..+"
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_broker(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Needs the Kafka connector on the cluster's class path."""
    return spark.readStream.format("kafka").options(**options).load()
