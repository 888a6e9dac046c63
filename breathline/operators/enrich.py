"""Row-wise classes and the city dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from breathline.functions import ladders
from breathline.schema import DIMENSION

# About 200 bytes a row: some 20 MB on each executor.
MAX_BROADCAST_ROWS = 100_000


def sized(side: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Marks a join side for broadcast only if it is small, which takes one small job. Beyond the bound Catalyst
    picks a shuffled join; adaptive execution splits its hot keys, but not on a stream with state, where it is
    off: there keep the dimension within the bound."""
    return F.broadcast(side) if side.limit(max_rows + 1).count() <= max_rows else side


def classify(measurements: DataFrame) -> DataFrame:
    return measurements.withColumns({
        "health_status": ladders.health_status(F.col("aqi")),
        "pollution_level": ladders.pollution_level(F.col("pm25"), F.col("pm10")),
    })


def enrich_city(measurements: DataFrame, dimension: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Adds the city's dimension row. Readings of an unknown city stay, with nulls."""
    return measurements.join(sized(dimension.select(*DIMENSION.names), max_rows), ["city"], "left").select(
        *measurements.columns, *[name for name in DIMENSION.names if name != "city"]
    )


def versions(history: DataFrame) -> DataFrame:
    """Rows of a dimension with ``valid_from``, and ``valid_to``: when the city's next version begins (null for the last).
    Of versions of one city and time one stays, the greatest by its other columns. A row without a city or time is no
    version."""
    others = [name for name in history.columns if name not in ("city", "valid_from")]
    one = history.where(F.col("city").isNotNull() & F.col("valid_from").isNotNull()).groupBy("city", "valid_from").agg(
        F.max(F.struct(*others)).alias("version")
    )
    after = F.lead("valid_from").over(Window.partitionBy("city").orderBy("valid_from"))
    return one.select("city", "valid_from", after.alias("valid_to"), "version.*")


def enrich_as_of(
    measurements: DataFrame, history: DataFrame, time: str = "measurement_time", max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Adds the city's dimension row as it was at the reading's time: ``history`` is the dimension with ``valid_from``.

    Readings before the first version, without a time or of an unknown city stay, with nulls. The join has the city as
    its key and the validity as a condition, so a reading meets the few versions of its city and no window gathers
    the readings of a city; where the history is too large to broadcast, adaptive execution splits the hot cities.
    """
    dated = versions(history.select("valid_from", *DIMENSION.names)).withColumnsRenamed(
        {"city": "_city", "valid_from": "_from", "valid_to": "_to"}
    )
    at, begin, end = F.col(time), F.col("_from"), F.col("_to")
    matches = (F.col("city") == F.col("_city")) & (begin <= at) & (end.isNull() | (at < end))
    return measurements.join(sized(dated, max_rows), matches, "left").select(
        *measurements.columns, *[name for name in DIMENSION.names if name != "city"]
    )
