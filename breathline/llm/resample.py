"""Importance resampling towards a target: documents whose words are like the target's are drawn more often.

Words are counted in hashed buckets, an array per task, over all documents and over the target; a document's
weight is the mean log ratio of its words' buckets. Noise that its id alone decides makes the best scores a draw
without replacement. The cutoff is found by sketches: a sketch of the scores gives a bracket around it, exact
counts beyond the bracket prove or widen it, and only a bracket that has become small is sorted.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from breathline.llm.base import documents, kept

BUCKETS = 10_000

# A bracket of at most so many rows is sorted; the sketch's size, and the share of ranks that a bracket takes at
# first to both sides of the rank sought.
SORTED_ROWS = 20_000
SKETCH = 4000
MARGIN = 0.004

LAST = (1 << 63) - 1
HASHES = float(1 << 32)

# ASCII letters and digits, lower-cased, and every byte beyond ASCII are parts of words; all else is a space.
WORD_BYTES = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or chr(byte).isalnum() else 32 for byte in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def buckets_of(words: list[bytes], grams: int, buckets: int) -> np.ndarray:
    """Bucket of every run of 1 to ``grams`` consecutive words, runs of one first."""
    features = list(words)
    for size in range(2, grams + 1):
        features += [b" ".join(words[at:at + size]) for at in range(len(words) - size + 1)]
    return np.fromiter(map(crc32, features), dtype=np.uint32, count=len(features)) % np.uint32(buckets)


def bucket_counts(texts: DataFrame, grams: int, buckets: int) -> np.ndarray:
    """Features of all whole texts by bucket. A task sends its array once, so the driver gets ``buckets`` sums."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                found = buckets_of(words_of(text.as_py() or ""), grams, buckets)
                counts += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(counts[held], pa.int64())], names=["bucket", "times"]
        )

    rows = texts.select("text").mapInArrow(count, "bucket int, times long")
    total = np.zeros(buckets, dtype=np.int64)
    for bucket, times in rows.groupBy("bucket").agg(F.sum("times").alias("times")).collect():
        total[bucket] = times
    return total


def gains_of(documents_: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares, rounded down."""
    size = len(target)
    here, there = float(documents_.sum() + size), float(target.sum() + size)
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * here / ((float(s) + 1) * there)))
        for s, t in zip(documents_, target)
    ], dtype=np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, grams: int) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text in batch.column(1):
                words = words_of(text.as_py())
                found = buckets_of(words, grams, len(gains))
                total = int(gains[found].sum())
                made.append((len(words), len(found), total // len(found) if len(found) else 0))
            columns = zip(*made) if made else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(column, pa.int64()) for column in columns]],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return documents(docs).mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, the same for an id wherever and whenever it is drawn."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.log(-F.log((drawn + F.lit(0.5)) / F.lit(HASHES))) * -1000)


def kth_largest(rows: DataFrame, column: str, k: int, sorted_rows: int = SORTED_ROWS, margin: float = MARGIN) -> tuple[int, int]:
    """The ``k``-th largest value of a long column, k from 1 to the rows, and how many values are larger.

    All passes count exactly; sketches only propose where to look, so neither their error nor their random choices
    reach the result.
    """
    value = F.col(column)
    above, inside = 0, rows.select(column)
    while True:
        sketch, size, lowest, highest = inside.agg(
            F.kll_sketch_agg_bigint(column, F.lit(SKETCH)), F.count("*"), F.min(column), F.max(column)
        ).first()
        if lowest == highest:
            return lowest, above
        if size <= sorted_rows:
            ordered = sorted((row[0] for row in inside.collect()), reverse=True)
            found = ordered[k - above - 1]
            return found, above + ordered.index(found)
        wanted, reach = k - above, margin
        while True:
            low, high = _bracket(rows.sparkSession, sketch, wanted / size, reach, lowest, highest)
            larger, within = inside.agg(F.count_if(value > high), F.count_if(value.between(low, high))).first()
            if larger < wanted <= larger + within:
                break
            reach *= 4
        if within == size:  # values so few that no bracket is smaller: halve the range instead
            middle = lowest + (highest - lowest) // 2
            larger = inside.agg(F.count_if(value > middle)).first()[0]
            low, high = (middle + 1, highest) if larger >= wanted else (lowest, middle)
            larger = 0 if larger >= wanted else larger
        above += larger
        inside = inside.where(value.between(low, high))


def _bracket(spark, sketch: bytes, share: float, reach: float, lowest: int, highest: int) -> tuple[int, int]:
    """Values at ranks around 1 - ``share``; the ends of the range where ``reach`` goes beyond them."""
    ranks = [1 - share - reach, 1 - share + reach]
    held = F.lit(bytes(sketch))
    low, high = spark.range(1).select(*[
        F.kll_sketch_get_quantile_bigint(held, F.lit(min(max(rank, 0.0), 1.0))).alias(f"at{end}")
        for end, rank in enumerate(ranks)
    ]).first()
    return lowest if ranks[0] <= 0 else low, highest if ranks[1] >= 1 else high


def importance_sample(
    docs: DataFrame, target: DataFrame, grams: int = 1, buckets: int = BUCKETS, least_words: int = 20, percent: int = 10,
    seed: int = 2024, sorted_rows: int = SORTED_ROWS,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; rank is null where the row is not drawn.

    ``percent`` of 100 of the rows with at least ``least_words`` words are drawn, rounded down, best scores first, ties
    to smaller doc_id, then (rows of one doc_id) to fewer features and smaller weight; a null doc_id comes last and
    has the noise of an id without digits. Null and empty texts have no features and weight 0. Words, counts and
    scores cover whole texts of all rows of both tables; an empty target is one without features; other columns
    are ignored; an empty table gives no rows.
    """
    gains = gains_of(bucket_counts(docs, grams, buckets), bucket_counts(target, grams, buckets))
    scored = kept(
        weighed(docs, gains, grams).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "resample-scores"
    )
    shown = ["doc_id", "n_features", "weight", "score"]
    eligible = F.col("n_words") >= least_words
    total = scored.where(eligible).count()
    drawn = total * percent // 100
    if not drawn:
        return scored.select(*shown, F.lit(None).cast("long").alias("rank"))
    # Smaller ids are better among equal scores: their complement is larger, and never overflows.
    reverse_id = F.bitwise_not(F.coalesce("doc_id", F.lit(LAST)))
    able = scored.where(eligible).select("score", reverse_id.alias("reverse_id"))
    cut, above = kth_largest(able, "score", drawn, sorted_rows)
    id_cut, _ = kth_largest(able.where(F.col("score") == cut), "reverse_id", drawn - above, sorted_rows)
    reached = eligible & ((F.col("score") > cut) | ((F.col("score") == cut) & (reverse_id >= id_cut)))
    ranked = _ranked(scored.where(reached)).select(*shown, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return ranked.unionAll(scored.where(~reached).select(*shown, F.lit(None).cast("long").alias("rank")))


def _ranked(rows: DataFrame) -> DataFrame:
    """Rows with their rank by score, then id. Rows are numbered among those of their score, behind all that have
    better scores. A score is a sum of two bounded logarithms in thousandths, so whatever the rows are, there are
    fewer than 150,000 different scores to be counted on the driver and broadcast; and as noise spreads equal
    texts, no score gathers more than a small share of them."""
    counted = sorted(rows.groupBy("score").count().collect(), reverse=True)
    sizes = [times for _, times in counted]
    before = pd.DataFrame({"score": [score for score, _ in counted], "before": np.cumsum([0, *sizes[:-1]])})
    spark = rows.sparkSession
    better = F.broadcast(spark.createDataFrame(before.astype("int64"), "score long, before long"))
    among = F.expr(
        "row_number() OVER (PARTITION BY score ORDER BY doc_id NULLS LAST, n_features, weight)"
    )
    return rows.withColumn("among", among).join(better, "score").withColumn("rank", F.col("before") + F.col("among"))
