from __future__ import annotations

import json
import os
import sys

import pytest
from rows import at

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from breathline.schema import MEASUREMENT, RECORD  # noqa: E402
from breathline.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        builder("tests").master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def record(spark):
    """Messages from (city, payload or raw text, time) triples; the offset is the position."""

    def make(rows, first_offset: int = 0):
        made = []
        for position, (city, payload, time) in enumerate(rows):
            text = payload if isinstance(payload, str) else json.dumps({"city": city, "payload": payload})
            key = None if city is None else city.encode()
            made.append((key, text.encode(), f"raw.airquality.{city}", 0, first_offset + position, at(time)))
        return spark.createDataFrame(made, RECORD)

    return make


@pytest.fixture(scope="session")
def reading(spark):
    """Measurement rows from dicts; absent fields are null."""

    def make(rows):
        return spark.createDataFrame([tuple(row.get(name) for name in MEASUREMENT.names) for row in rows], MEASUREMENT)

    return make
