"""Names derived from a city key."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# Cities whose feed address differs from their key.
FEED_SLUGS = {"cantho": "can-tho", "nhatrang": "nha-trang", "vungtau": "vung-tau"}

# Fixed value: default topic prefix.
TOPIC_PREFIX = "raw.airquality"


def feed_slug(city: Column) -> Column:
    slugs = F.create_map(*[F.lit(part) for part in chain.from_iterable(FEED_SLUGS.items())])
    return F.coalesce(F.try_element_at(slugs, city), city)


def topic(city: Column, prefix: str = TOPIC_PREFIX) -> Column:
    return F.concat_ws(".", F.lit(prefix), city)


def city_of(key: Column, topic_name: Column) -> Column:
    """City of a message: its key, or the last part of its topic where the key is missing."""
    return F.coalesce(key.cast("string"), F.substring_index(topic_name, ".", -1))
