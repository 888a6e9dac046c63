"""Class labels from ordered bounds, as plain column expressions: they stay in generated code and can be
pushed into a scan filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Upper bounds (inclusive) and labels of the air-quality index.
HEALTH_STEPS = [
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
]
HEALTH_TOP = "Hazardous"

# Upper bounds (exclusive) and labels of the particulate level.
LEVEL_STEPS = [(50, "Low"), (100, "Medium"), (150, "High")]
LEVEL_TOP = "Severe"

UNKNOWN = "Unknown"

LEVELS = [label for _, label in LEVEL_STEPS] + [LEVEL_TOP, UNKNOWN]

# Dimension columns that hold a city's own bounds, in the order of HEALTH_STEPS.
THRESHOLD_COLUMNS = [
    "aqi_threshold_good",
    "aqi_threshold_moderate",
    "aqi_threshold_unhealthy_sensitive",
    "aqi_threshold_unhealthy",
    "aqi_threshold_very_unhealthy",
]


def _ladder(unknown: Column, steps: Sequence[tuple[Column, str]], top: str) -> Column:
    label = F.when(unknown, UNKNOWN)
    for reached, name in steps:
        label = label.when(reached, name)
    return label.otherwise(top)


def health_status(aqi: Column) -> Column:
    return _ladder(aqi.isNull(), [(aqi <= bound, name) for bound, name in HEALTH_STEPS], HEALTH_TOP)


def health_status_by_city(aqi: Column) -> Column:
    """Same labels, bounds taken from the joined city where it has them."""
    steps = [
        (aqi <= F.coalesce(F.col(column), F.lit(bound)), name)
        for column, (bound, name) in zip(THRESHOLD_COLUMNS, HEALTH_STEPS)
    ]
    return _ladder(aqi.isNull(), steps, HEALTH_TOP)


def pollution_level(pm25: Column, pm10: Column) -> Column:
    """The worse of the two values; a missing one counts as 0, and NaN as missing."""
    missing = F.lit(None).cast("double")
    fine, coarse = F.nanvl(pm25, missing), F.nanvl(pm10, missing)
    worse = F.greatest(F.coalesce(fine, F.lit(0.0)), F.coalesce(coarse, F.lit(0.0)))
    return _ladder(
        fine.isNull() & coarse.isNull(), [(worse < bound, name) for bound, name in LEVEL_STEPS], LEVEL_TOP
    )
