"""Suffix-array dedup: removes every byte that lies in a string of ``length`` bytes which also starts elsewhere.

A window of ``length`` bytes is filed under the least hash of the ``ANCHOR``-byte strings in it, so equal
windows are filed under one key wherever they stand, and neighbouring windows mostly share theirs: the run of
windows with one key is a segment. Segments of equal content cover each other; their rows are folded together
in each input slice before anything is shuffled. Only keys with several contents (or an anchor that repeats
inside a segment) need the bytes: these are fetched, cut to what a neighbour can share around the anchor, and
suffix-sorted by linear grouping; equal windows are then neighbours in the suffix array.

A key with more than ``LIMIT`` contents is not sorted in one task: each of its windows goes, as a 128-bit
hash, to the rows with the same hash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from breathline.llm.base import kept
from breathline.llm.gsaca import suffix_array

LENGTH = 200
ANCHOR = 64
LIMIT = 4096
# Bytes scanned at once, and the longest run of windows that is one segment.
SLICE_BYTES = 1 << 20
LONGEST_RUN = 1 << 16

SEGMENT = "struct<key: long, content: long, start: int, size: int, anchor: int, again: boolean, times: int>"
SCANNED = f"row long, digest binary, segments array<{SEGMENT}>, covered array<struct<start: int, size: int>>"
SPANS = "row long, digest binary, start int, size int"
FETCHED = "key long, row long, digest binary, start int, anchor int, again boolean, lone boolean, bytes binary"

ODD = [np.uint64(n) for n in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def anchored(data: np.ndarray, anchor: int) -> np.ndarray:
    """Hashes of all strings of ``anchor`` bytes (a power of two), by doubling."""
    hashed = data.astype(np.uint64) * ODD[0]
    hashed ^= hashed >> np.uint64(29)
    size = 1
    while size < anchor:
        joined = hashed[: len(hashed) - size] * ODD[1]
        joined += hashed[size:]
        joined ^= joined >> np.uint64(31)
        joined *= ODD[2]
        hashed, size = joined, size * 2
    return hashed


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[: len(values) - size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def segments(pieces: list[bytes], length: int, anchor: int) -> dict[str, np.ndarray]:
    """The segments of all pieces: number of the piece, start in it, size, key, place of the anchor and whether
    the anchor's bytes occur again in the segment."""
    sizes = np.array([len(piece) for piece in pieces])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    none = np.empty(0, dtype=np.int64)
    if len(data) < length:
        return dict.fromkeys(("piece", "start", "size", "key", "anchor"), none) | {"again": none.astype(bool)}
    hashed = anchored(data, anchor)
    width = length - anchor + 1
    lowest = least(hashed, width)
    inside = np.zeros(len(lowest) + 1, dtype=np.int32)
    long_enough = sizes >= length
    inside[starts[long_enough]] += 1
    inside[ends[long_enough] - length + 1] -= 1
    windows = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    piece = np.searchsorted(ends, windows, "right")
    key = lowest[windows]
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (piece[1:] != piece[:-1])
    since = np.arange(len(windows)) - np.maximum.accumulate(np.where(new, np.arange(len(windows)), 0))
    new |= since % LONGEST_RUN == 0
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(windows)))
    start, key, piece = windows[first], key[first], piece[first]
    # Anchor positions of a segment: from its start to the last that its last window holds.
    spans = count + width - 1
    at = np.repeat(start - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
    hits = np.flatnonzero(hashed[at] == np.repeat(key, spans))
    owner = np.searchsorted(np.cumsum(spans), hits, "right")
    times = np.bincount(owner, minlength=len(first))
    place = np.zeros(len(first), dtype=np.int64)
    place[owner[::-1]] = at[hits][::-1]  # the first of a segment is written last
    return {
        "piece": piece, "start": start - starts[piece], "size": count + length - 1, "key": key.view(np.int64),
        "anchor": place - start, "again": times > 1,
    }


def _pieces(texts: list[bytes], length: int) -> tuple[list[int], list[int], list[bytes]]:
    """Documents and offsets of pieces of bounded size, overlapping so that each window lies in one piece."""
    owners, offsets, pieces = [], [], []
    for number, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - length + 1), SLICE_BYTES):
            owners.append(number)
            offsets.append(offset)
            pieces.append(text[offset:offset + SLICE_BYTES + length - 1])
    return owners, offsets, pieces


def _rounds(pieces: list[bytes]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for place, piece in enumerate(pieces):
        if place > start and size + len(piece) > SLICE_BYTES:
            yield start, place
            start, size = place, 0
        size += len(piece)
    if len(pieces) > start:
        yield start, len(pieces)


def _scan(length: int, anchor: int):
    kind = pa.struct([("key", pa.int64()), ("content", pa.int64()), ("start", pa.int32()), ("size", pa.int32()),
                      ("anchor", pa.int32()), ("again", pa.bool_()), ("times", pa.int32())])
    span = pa.struct([("start", pa.int32()), ("size", pa.int32())])

    def lists(owner: np.ndarray, rows: int, fields: list[np.ndarray], of: pa.StructType) -> pa.ListArray:
        order = np.argsort(owner, kind="stable")
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))]).astype(np.int32)
        values = pa.StructArray.from_arrays(
            [pa.array(field[order], type=part.type) for field, part in zip(fields, of)], fields=list(of)
        )
        return pa.ListArray.from_arrays(pa.array(offsets), values)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.encode() for text in batch.column(2).to_pylist()]
            owners, offsets, pieces = _pieces(texts, length)
            owners, offsets = np.array(owners, dtype=np.int64), np.array(offsets, dtype=np.int64)
            found = []
            for start, end in _rounds(pieces):
                one = segments(pieces[start:end], length, anchor)
                content = [
                    xxhash.xxh3_64_intdigest(pieces[start + p][s:s + n])
                    for p, s, n in zip(one["piece"].tolist(), one["start"].tolist(), one["size"].tolist())
                ]
                one["content"] = np.array(content, dtype=np.uint64).view(np.int64)
                one["piece"] = one["piece"] + start
                found.append(one)
            all_ = {name: np.concatenate([one[name] for one in found]) for name in found[0]} if found else None
            if not all_:
                continue
            owner = owners[all_["piece"]]
            start = offsets[all_["piece"]] + all_["start"]
            # Rows of equal content in this batch: all are covered, and one of them stands for them.
            order = np.lexsort((all_["content"], all_["key"]))
            same = np.ones(len(order), dtype=bool)
            key, content = all_["key"][order], all_["content"][order]
            same[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
            group = np.cumsum(same) - 1
            size = np.bincount(group, minlength=int(same.sum()))
            several = order[size[group] > 1]
            alone = order[same]
            times = np.minimum(size, 2)
            sent = [all_["key"][alone], all_["content"][alone], start[alone], all_["size"][alone],
                    all_["anchor"][alone], all_["again"][alone], times]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists(owner[alone], len(texts), sent, kind),
                 lists(owner[several], len(texts), [start[several], all_["size"][several]], span)],
                names=["row", "digest", "segments", "covered"],
            )

    return scan


def _fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts the wanted segments out of their texts."""
    for batch in batches:
        rows: list[tuple] = []
        texts = batch.column(2)
        for place, (row, digest, wanted) in enumerate(
            zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist())
        ):
            text = texts[place].as_py().encode()
            rows += [
                (one["key"], row, digest, one["start"], one["anchor"], one["again"], one["lone"],
                 text[one["start"]:one["start"] + one["size"]])
                for one in wanted
            ]
        if rows:
            yield _batch(rows, FETCH_ARROW)


FETCH_ARROW = pa.schema([
    ("key", pa.int64()), ("row", pa.int64()), ("digest", pa.binary()), ("start", pa.int32()),
    ("anchor", pa.int32()), ("again", pa.bool_()), ("lone", pa.bool_()), ("bytes", pa.binary()),
])
SPAN_ARROW = pa.schema([("row", pa.int64()), ("digest", pa.binary()), ("start", pa.int32()), ("size", pa.int32())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, type=field.type) for column, field in zip(columns, schema)], schema=schema
    )


def _sort_buckets(length: int):
    """Rows come sorted by key. Emits the spans of lone segments that another window repeats."""

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, bucket, made = None, [], []
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            for one in zip(*columns):
                if one[0] != key:
                    made += bucket_spans(bucket, length)
                    key, bucket = one[0], []
                bucket.append(one)
            if made:
                yield _batch(made, SPAN_ARROW)
                made = []
        made = bucket_spans(bucket, length)
        if made:
            yield _batch(made, SPAN_ARROW)

    return sort


def bucket_spans(bucket: list[tuple], length: int) -> list[tuple]:
    """Spans (row, digest, start, size) of a bucket's lone segments that are covered by repeated windows."""
    if not bucket:
        return []
    parts = [one[7] for one in bucket]
    offsets = [0] * len(bucket)
    if not any(one[5] for one in bucket):
        parts, offsets = _shared_parts(parts, [one[4] for one in bucket], length)
    by_text: dict[bytes, list[int]] = {}
    for number, part in enumerate(parts):
        if len(part) >= length:
            by_text.setdefault(part, []).append(number)
    texts = list(by_text)
    covered = repeated_windows(texts, length)
    spans = []
    for text, found in zip(texts, covered):
        if len(by_text[text]) > 1:
            found = [(0, len(text))]
        for number in by_text[text]:
            _, row, digest, start, _, _, lone, _ = bucket[number]
            if lone:
                spans += [(row, digest, start + offsets[number] + at, size) for at, size in found]
    return spans


def _shared_parts(parts: list[bytes], anchors: list[int], length: int) -> tuple[list[bytes], list[int]]:
    """Each segment cut to the farthest that any other agrees with it to the left and right of their one common
    anchor. No repeated window reaches beyond; what is shorter than a window cannot hold one."""
    right = _agreements([part[at:] for part, at in zip(parts, anchors)])
    left = _agreements([part[:at][::-1] for part, at in zip(parts, anchors)])
    cut = [
        part[at - before:at + after] if before + after >= length else b""
        for part, at, before, after in zip(parts, anchors, left, right)
    ]
    return cut, [at - before for at, before in zip(anchors, left)]


def _agreements(texts: list[bytes]) -> list[int]:
    order = sorted(range(len(texts)), key=texts.__getitem__)
    most = [0] * len(texts)
    for one, two in zip(order, order[1:]):
        common = _common(texts[one], texts[two])
        most[one], most[two] = max(most[one], common), max(most[two], common)
    return most


def _common(one: bytes, two: bytes) -> int:
    low, high = 0, min(len(one), len(two))
    if one[:high] == two[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if one[low:middle] == two[low:middle]:
            low = middle
        else:
            high = middle
    return low


def repeated_windows(texts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For each text the runs (start, size) covered by windows that occur more than once in the texts."""
    if not texts or len(texts) == 1 and len(texts[0]) <= length:
        return [[] for _ in texts]
    symbols: list[int] = []
    owner: list[int] = []
    starts = []
    for number, text in enumerate(texts):
        starts.append(len(symbols))
        symbols += [byte + 2 for byte in text]
        symbols.append(1)
        owner += [number] * (len(text) + 1)
    symbols.append(0)
    owner.append(-1)
    hits: list[list[int]] = [[] for _ in texts]
    before = None
    for at in suffix_array(symbols):
        number = owner[at]
        place = at - starts[number] if number >= 0 else 0
        window = texts[number][place:place + length] if number >= 0 else b""
        if len(window) < length:
            before = None
            continue
        if before is not None and before[2] == window:
            hits[before[0]].append(before[1])
            hits[number].append(place)
        before = (number, place, window)
    return [_runs(sorted(set(places)), length) for places in hits]


def _runs(places: list[int], length: int) -> list[tuple[int, int]]:
    runs: list[tuple[int, int]] = []
    for place in places:
        if runs and place <= runs[-1][0] + runs[-1][1]:
            runs[-1] = (runs[-1][0], place + length - runs[-1][0])
        else:
            runs.append((place, length))
    return runs


def _window_hashes(length: int):
    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in zip(*[column.to_pylist() for column in batch.columns]):
                text = one[7]
                places = range(len(text) - length + 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array([xxhash.xxh3_128_digest(text[at:at + length]) for at in places], pa.binary()),
                    pa.array([one[1]] * len(places), pa.int64()), pa.array([one[2]] * len(places), pa.binary()),
                    pa.array([one[3] + at for at in places], pa.int32()),
                    pa.array([one[6]] * len(places), pa.bool_()),
                ], names=["window", "row", "digest", "start", "lone"])

    return each


def _kept_bytes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, runs, texts = [], [], []
        for text, spans in zip(batch.column(2), batch.column(3).to_pylist()):
            data, left, end, gone, count = text.as_py().encode(), [], 0, 0, 0
            for start, stop in sorted((one["start"], one["start"] + one["size"]) for one in spans or []):
                if start > end or not count:
                    left.append(data[end:start])
                    count += 1
                    gone += stop - start
                    end = stop
                elif stop > end:
                    gone += stop - end
                    end = stop
            left.append(data[end:])
            removed.append(gone)
            runs.append(count)
            texts.append(b"".join(left))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(4), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
             pa.array(texts, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def _texts(docs: DataFrame) -> DataFrame:
    """Rows by (row, digest), both never null: equal rows are alike in all that follows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("row"),
        F.coalesce(F.unhex(F.md5(F.encode(text, "UTF-8"))), F.lit(b"")).alias("digest"), text.alias("text"),
    )


def _struct(*names: str) -> Column:
    return F.struct(*[F.col(name) for name in names])


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, limit: int = LIMIT) -> DataFrame:
    """Every row with what is left of it: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the
    bytes outside them).

    Texts are UTF-8 bytes, null counts as empty, and a text shorter than ``length`` loses nothing. Rows that
    repeat a doc_id or a text are documents of their own, and so lose every byte that a window covers. An empty
    table gives no rows; other columns are ignored.
    """
    texts = _texts(docs)
    scanned = kept(texts.mapInArrow(_scan(length, anchor), SCANNED), "repeats-scanned")
    known = scanned.where(F.size("covered") > 0).select("row", "digest", F.explode("covered").alias("one")).select(
        "row", "digest", "one.start", "one.size"
    )
    marked = kept(_marked(scanned, limit), "repeats-marked")
    copied = marked.where("times > 1").select("row", "digest", "start", "size")
    wanted = marked.where("wanted").withColumn("lone", F.col("times") == 1)
    parts = _fetched(texts, wanted.where("not crowded"))
    sorted_ = parts.repartition("key").sortWithinPartitions("key").mapInArrow(_sort_buckets(length), SPANS)
    spans = known.unionByName(copied).unionByName(sorted_)
    crowded = wanted.where("crowded")
    if not crowded.isEmpty():
        spans = spans.unionByName(_crowded(texts, crowded, length))
    by_row = spans.groupBy("row", "digest").agg(F.collect_list(_struct("start", "size")).alias("spans"))
    joined = texts.join(by_row.hint("shuffle_hash"), ["row", "digest"], "left").select(
        "row", "digest", "text", "spans", F.octet_length("text").cast("long").alias("n_bytes")
    )
    left = joined.mapInArrow(_kept_bytes, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return left.withColumn("doc_id", F.when(F.col("doc_id") != F.lit(-(1 << 63)), F.col("doc_id")))


def _marked(scanned: DataFrame, limit: int) -> DataFrame:
    """Segments that occur more than once, or whose bytes are wanted: the first of each content of a key with
    several contents, or of one that may repeat inside itself."""
    rows = scanned.select("row", "digest", F.explode("segments").alias("one")).select("row", "digest", "one.*")
    of_key, of_content = Window.partitionBy("key"), Window.partitionBy("key", "content")
    # Shuffled by key alone, and sorted once: by key and content.
    counted = (
        rows.repartition("key")
        .withColumn("number", F.row_number().over(of_content.orderBy("row", "digest", "start")))
        .withColumn("all_times", F.sum("times").over(of_content))
        .withColumn("contents", F.sum(F.when(F.col("number") == 1, 1).otherwise(0)).over(of_key))
    )
    first = F.col("number") == 1
    return counted.select(
        "key", "row", "digest", "start", "size", "anchor", "again", F.col("all_times").alias("times"),
        (first & ((F.col("contents") > 1) | F.col("again"))).alias("wanted"),
        (F.col("contents") > limit).alias("crowded"),
    ).where("times > 1 or wanted")


def _fetched(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    lists = wanted.groupBy("row", "digest").agg(
        F.collect_list(_struct("key", "start", "size", "anchor", "again", "lone")).alias("wanted")
    )
    found = texts.join(lists.hint("shuffle_hash"), ["row", "digest"]).select("row", "digest", "text", "wanted")
    return found.mapInArrow(_fetch, FETCHED)


def _crowded(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The exact way for keys with too many contents: windows of the same hash, counted with partial sums."""
    # Part of the same plan as the rest, so that the shuffle of the texts is reused.
    windows = _fetched(texts, wanted).mapInArrow(
        _window_hashes(length), "window binary, row long, digest binary, start int, lone boolean"
    )
    repeated = windows.groupBy("window").agg(F.count("*").alias("times")).where("times > 1").select("window")
    return windows.where("lone").join(repeated, "window", "left_semi").select(
        "row", "digest", "start", F.lit(length).cast("int").alias("size")
    )
