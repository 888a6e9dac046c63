"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from breathline.llm.base import kept


def components(links: DataFrame) -> DataFrame:
    """``node`` and the smallest node of its component, for every node of ``links`` (a, b) that is not the
    smallest itself. Each step is an aggregation with partial sums and a join; the number of steps grows with
    the logarithm of the longest chain. A node with very many links meets them in a join that adaptive
    execution can split."""
    edges = kept(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    state = _state(edges)
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select("b", "low").toDF("a", "b")
        edges = kept(low.toDF("a", "b").unionAll(small).distinct(), "links")
        before, state = state, _state(edges)
        if before == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _state(edges: DataFrame) -> tuple:
    """Number of links and a sum of their hashes: equal for equal tables."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
