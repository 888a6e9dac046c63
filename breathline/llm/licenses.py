"""License scan: an exact set-similarity join of text blocks with license templates.

A text's words fall into overlapping blocks, so that any run of words up to a block's stride is whole in one. A
block matches a template when it contains at least ``THRESHOLD`` of the template's distinct words. Words are put
into one global order, rarest in the whole corpus first; only blocks that hold a word of some template's prefix
are kept, reduced to template words, which changes no overlap. They are joined to the templates on the words of
the template prefix, pairs that the block's length or the words' positions rule out are dropped, and the rest
are verified by their overlap.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from breathline.llm.base import documents, kept

THRESHOLD = 0.85
# Words from one block's start to the next one's, or those of the longest template if it has more.
STRIDE = 24
# Templates come as a parameter; more than this many are not broadcast.
BROADCAST_ROWS = 10_000

# Phrases that are looked for as consecutive words, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices by label.
TEMPLATES = {
    "agpl": "gnu affero general public license",
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by-4.0": "licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under a creative commons attribution sharealike 4 0 international license",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "isc": "permission to use copy modify and or distribute this software for any purpose is hereby granted",
    "lgpl": "gnu lesser general public license",
    "mit": "released under the mit license",
    "mpl-2.0": "subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}

WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
SCANNED = (
    "row long, doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    "blocks array<struct<start: long, tokens: array<int>>>"
)
ARROW = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
    ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())),
    ("blocks", pa.list_(pa.struct([("start", pa.int64()), ("tokens", pa.list_(pa.int32()))]))),
])


def words(text: str) -> list[bytes]:
    """Bytes lower-case A-Z only; every byte above ASCII belongs to a word."""
    return WORDS.findall(text.encode("utf-8", "surrogatepass").lower())


def _counting(vocabulary: frozenset[bytes]):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found.update([word for word in words(text) if word in vocabulary])
        yield pa.RecordBatch.from_arrays(
            [pa.array([word.decode() for word in found], pa.string()), pa.array(list(found.values()), pa.int64())],
            names=["word", "times"],
        )

    return count


def global_order(docs: DataFrame, vocabulary: set[str]) -> dict[str, int]:
    """Place of each template word, the rarest in all texts first. The driver gets a number per word."""
    counted = documents(docs).select("text").mapInArrow(
        _counting(frozenset(word.encode() for word in vocabulary)), "word string, times long"
    )
    times = dict.fromkeys(vocabulary, 0)
    times.update({row["word"]: row["times"] for row in counted.groupBy("word").agg(F.sum("times").alias("times")).collect()})
    return {word: place for place, word in enumerate(sorted(times, key=lambda word: (times[word], word)))}


def needed(size: int, threshold: float) -> int:
    return math.ceil(threshold * size - 1e-9)


def _scanning(order: dict[str, int], rare: set[int], phrases: dict[str, str], width: int, stride: int):
    places = {word.encode(): place for word, place in order.items()}
    anchors = {word for word, place in places.items() if place in rare}
    starts: dict[bytes, list[tuple[list[bytes], str]]] = {}
    for phrase, label in phrases.items():
        parts = [part.encode() for part in phrase.split()]
        starts.setdefault(parts[0], []).append((parts, label))
    interesting = anchors | set(starts)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            made = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = words(text)
                hits, labels, held = [], set(), set()
                for at in [at for at, word in enumerate(found) if word in interesting]:
                    word = found[at]
                    for parts, label in starts.get(word, ()):
                        if found[at:at + len(parts)] == parts:
                            hits.append(at)
                            labels.add(label)
                    if word in anchors:
                        last = at // stride
                        held.update(range(max(0, (at - width) // stride + 1), last + 1))
                blocks = [
                    {"start": number * stride, "tokens": sorted({
                        places[word] for word in found[number * stride:number * stride + width] if word in places
                    })}
                    for number in sorted(held)
                ]
                made.append((row, doc_id, len(found), len(hits), min(hits, default=None), max(hits, default=None),
                             sorted(labels), blocks))
                row += 1
            if made:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, type=field.type) for column, field in zip(zip(*made), ARROW)], schema=ARROW
                )

    return scan


def template_rows(spark: SparkSession, templates: dict[str, str], order: dict[str, int], threshold: float) -> DataFrame:
    """Label, tokens in global order and the overlap a block needs."""
    rows = []
    for label, text in sorted(templates.items()):
        tokens = sorted({order[word] for word in text.split()})
        rows.append((label, tokens, needed(len(tokens), threshold)))
    return spark.createDataFrame(rows, "label string, template array<int>, needed int")


def contained(blocks: DataFrame, templates: DataFrame) -> DataFrame:
    """The exact join: blocks (row, start, tokens) with templates (label, template, needed), on prefix tokens,
    with the length and the positional filter, verified; adds ``containment``."""
    prefixes = templates.select("label", "template", "needed", F.posexplode(
        F.slice("template", F.lit(1), F.size("template") - F.col("needed") + 1)).alias("place", "token"))
    if prefixes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        prefixes = F.broadcast(prefixes)
    tokens = blocks.select("row", "start", "tokens", F.posexplode("tokens").alias("at", "token"))
    rest = F.least(F.size("template") - F.col("place"), F.size("tokens") - F.col("at"))
    candidates = (
        tokens.join(prefixes, "token")
        .where((F.size("tokens") >= F.col("needed")) & (rest >= F.col("needed")))
        .select("row", "start", "label", "tokens", "template", "needed").dropDuplicates(["row", "start", "label"])
    )
    common = F.size(F.array_intersect("tokens", "template"))
    return candidates.where(common >= F.col("needed")).select(
        "row", "start", "label", (common / F.size("template")).alias("containment")
    )


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None,
    threshold: float = THRESHOLD, stride: int = STRIDE,
) -> DataFrame:
    """Every row with its phrases and the templates that any of its blocks contains: doc_id, n_words, n_base,
    first_word, last_word, base_labels, labels, score (1 with a phrase, else the largest containment found, or 0).

    Null and empty texts have no words and no label. Repeated rows are scanned each; an empty table gives no
    rows; other columns are ignored. Blocks are twice as long as the distance of their starts, which is at least
    that of the longest template, so a template of any length that stands in a text is whole in one of them.
    """
    templates, phrases = templates or TEMPLATES, phrases or PHRASES
    stride = max([stride, *[len(text.split()) for text in templates.values()]])
    spark = docs.sparkSession
    order = global_order(docs, {word for text in templates.values() for word in text.split()})
    notices = template_rows(spark, templates, order, threshold)
    rare = set()
    for text in templates.values():
        tokens = sorted({order[word] for word in text.split()})
        rare.update(tokens[: len(tokens) - needed(len(tokens), threshold) + 1])
    scanned = kept(
        documents(docs).mapInArrow(_scanning(order, rare, phrases, 2 * stride, stride), SCANNED), "license-blocks"
    )
    blocks = scanned.select("row", F.explode("blocks").alias("block")).select("row", "block.start", "block.tokens")
    found = contained(blocks, notices).groupBy("row").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("containment")
    )
    none = F.array().cast("array<string>")
    return scanned.join(found.hint("shuffle_hash"), "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", F.coalesce("found", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
