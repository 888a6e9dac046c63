"""Exact n-gram Jaccard join by PartEnum signatures.

Sets are put into bands of nearly equal size. Within a band, sets similar enough differ in at most ``h``
elements. The domain of hashed shingles is divided into parts, so many that two such sets differ in at most ``SPREAD``
elements on one of them; each part is divided again into ``PIECES`` pieces, and every subset that leaves out
``SPREAD`` of its pieces is enumerated. One of these holds no element in which the two sets differ, and is not empty.
What a set holds of a subset (with band, part and subset) is a signature of the set. A set signs for its own band
and for the next, as its partner may be a band larger.

Sets that share a signature are candidates; equal sets are one representative. A signature of few sets gives all
their pairs. A signature of many names two of them its leaders, as links are wanted as components: a set gives pairs with
the ``LEADERS`` that most of its signatures name, however many they name in a large group; then a signature's sets that still lie in different components are compared with each other: inside the signature if they are no
more than a block, else in blocks of the sets that such signatures connect.
Before sets are fetched and intersected, pairs are held against a lower bound of their difference: a set's parity
bits, one flipped per element, differ in no more places than two sets differ in elements.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from breathline.llm.base import ascii_words, documents, kept
from breathline.llm.links import components

# Documents whose word hashes are remembered together; sets and elements that one side of a comparison holds.
SLICE = 512
BLOCK = 512
BLOCK_ELEMENTS = 500_000
# Sets of a signature whose pairs are all compared, and words of 64 parity bits.
FEW = 8
PARITY = 16
# Leaders that a set is compared with at most; what they do not join is compared within its signatures.
LEADERS = 4
# Differences that a part is let have, and pieces that it is divided into.
SPREAD = 1
PIECES = 3
SUBSETS = [list(left_out) for left_out in combinations(range(PIECES), SPREAD)]
# A pair of blocks of one family.
KEYS = ["family", "i", "j", "inner"]

SHAPED = "doc_id long, n_shingles long, set_hash binary, parity array<long>"
SIGNED = "rep long, signatures array<long>"
# Orders in which the second leader of a signature is the first.
ORDERS = 8

MIX = [np.uint64(n) for n in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
SHIFT = np.uint64(32)
LOW = np.uint64((1 << 32) - 1)


def mixed(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """An even spread of 64-bit values."""
    values = values + np.uint64(int(MIX[salt % 4]) * (salt + 1) & (1 << 64) - 1)
    values = (values ^ (values >> SHIFT)) * MIX[3]
    values = (values ^ (values >> np.uint64(29))) * MIX[1]
    return values ^ (values >> SHIFT)


class Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str, width: int, hashes: Hashes) -> np.ndarray:
    """Distinct 64-bit hashes of the text's shingles, in order; fewer words than ``width`` are one shingle."""
    words = ascii_words(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashed = np.array([hashes[word] for word in words], dtype=np.uint64)
    size = min(width, len(words))
    state = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for place in range(size):
        state = mixed(state ^ hashed[place:place + len(state)], place)
    return np.unique(state)


def parity(elements: np.ndarray) -> np.ndarray:
    """One bit of ``PARITY`` words flipped for each element."""
    place = (mixed(elements, 9) >> np.uint64(40)).astype(np.int64) % (64 * PARITY)
    odd = np.bincount(place, minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


class Bands:
    """Size bands of a threshold: sizes of a band differ by no more than two linked sets' sizes can."""

    def __init__(self, shared: int, of: int):
        self.shared, self.of = shared, of
        self.tops = [0]

    def _grow(self, size: int) -> None:
        while self.tops[-1] < size:
            low = self.tops[-1] + 1
            self.tops.append(max(low, low * self.of // self.shared))

    def of_size(self, size: int) -> int:
        self._grow(size)
        return int(np.searchsorted(self.tops, size))

    def differing(self, band: int) -> int:
        """Elements that two linked sets of the band (or one of it, one of the band below) can differ in."""
        while len(self.tops) <= band:
            self._grow(self.tops[-1] + 1)
        return 2 * self.tops[band] * (self.of - self.shared) // (self.of + self.shared)

    def parts(self, band: int) -> tuple[int, int]:
        """The parts made, and how many of them at least have no more than ``SPREAD`` of two linked sets' differences.
        Some are to spare, so that one of these has no empty subset."""
        beyond = self.differing(band) // (SPREAD + 1)
        top = self.tops[band]
        # A subset holds at least this many elements on average, and so is empty in about exp(-load) of all cases.
        load = (self.shared / self.of) ** 2 * top / (beyond + 1) * (PIECES - SPREAD) / PIECES
        spare = math.ceil(2 * min(1, len(SUBSETS) * math.exp(-load)) * beyond)
        return beyond + 1 + spare, 1 + spare

    def signatures(self, elements: np.ndarray) -> np.ndarray:
        if not len(elements):
            return np.empty(0, dtype=np.int64)
        own = self.of_size(len(elements))
        place, value = mixed(elements, 5), mixed(elements, 6)
        place, piece = (place >> SHIFT).astype(np.int64), (place & LOW).astype(np.int64) % PIECES
        made = []
        for band in (own, own + 1):
            if not self.differing(band):  # equal sets only
                made.append(mixed(np.array([value.sum()]) ^ mixed(np.array([band << 32], dtype=np.uint64), 7), 8))
                continue
            parts, good = self.parts(band)
            at = place % parts * PIECES + piece
            content = np.zeros(parts * PIECES, dtype=np.uint64)
            np.add.at(content, at, value)
            content = content.reshape(parts, PIECES)
            filled = np.bincount(at, minlength=parts * PIECES).reshape(parts, PIECES)
            held = np.stack([content.sum(axis=1) - content[:, out].sum(axis=1) for out in SUBSETS], axis=1)
            empty = np.stack([filled.sum(axis=1) == filled[:, out].sum(axis=1) for out in SUBSETS], axis=1)
            number = np.arange(held.size, dtype=np.uint64).reshape(held.shape)
            sign = mixed(held ^ mixed(number + np.uint64(band << 32), 7), 8)
            # Fewer parts with an empty subset than good ones: some good part has none, and its subset is shared.
            made.append(sign[~empty] if empty.any(axis=1).sum() < good else sign.ravel())
        return np.unique(np.concatenate(made)).view(np.int64)


def _shaping(width: int):
    def shape(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sliced(batches, width):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(one) for one in sets], pa.int64()), _digests(sets),
                 pa.array([parity(one) for one in sets], pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_hash", "parity"],
            )

    return shape


def _signing(width: int, shared: int, of: int):
    """Signatures of texts whose set is the one named beside them; a doc_id's other texts sign nothing."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(shared, of)
        for part, sets in _sliced(batches, width):
            wanted = zip(sets, _digests(sets).to_pylist(), part.column(2).to_pylist())
            signs = [bands.signatures(one) if found == asked else [] for one, found, asked in wanted]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(signs, pa.list_(pa.int64()))], names=["rep", "signatures"]
            )

    return sign


def _sliced(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part, hashes = batch.slice(at, SLICE), Hashes()
            yield part, [shingles(text, width, hashes) for text in part.column(1).to_pylist()]


def _digests(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([xxhash.xxh3_128_digest(one.tobytes()) for one in sets], pa.binary())


def _listing(width: int):
    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sliced(batches, width):
            elements = pa.array([one.view(np.int64) for one in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), elements], names=["rep", "elements"])

    return each


def jaccard_components(docs: DataFrame, width: int = 5, shared: int = 8, of: int = 10) -> DataFrame:
    """Every row with its set size and the smallest doc_id that links lead to: doc_id, n_shingles, component_id.

    Documents link when ``of`` * |intersection| >= ``shared`` * |union|, over sets of distinct ``width``-word
    shingles (64-bit hashes). Null, empty and blank texts have an empty set, link with nothing and are their own
    component. Rows that repeat a doc_id are copies of one document; rows without a doc_id are left out, as no
    class could name them. An empty table gives no rows.
    """
    texts = documents(docs).where(F.col("doc_id").isNotNull())
    shaped = kept(texts.mapInArrow(_shaping(width), SHAPED), "jaccard-shapes")
    filled = shaped.where("n_shingles > 0")
    classes = kept(filled.groupBy("set_hash").agg(F.min("doc_id").alias("rep")), "jaccard-classes")
    # All rows of a representative's doc_id are alike, as they are copies; one of them is enough.
    of_class = filled.withColumnRenamed("doc_id", "rep").join(
        classes.hint("shuffle_hash"), ["set_hash", "rep"], "left_semi"
    )
    # Signatures are made in a scan of their own: they are larger than all else that is kept, and than the texts, so that
    # these meet the classes, and a signature is moved once.
    of_rep = texts.join(classes.withColumnRenamed("rep", "doc_id").hint("shuffle_hash"), "doc_id")
    signed = (
        of_rep.select("doc_id", "text", "set_hash").mapInArrow(_signing(width, shared, of), SIGNED)
        .select(F.explode("signatures").alias("signature"), "rep").repartition("signature")
    )
    groups = (
        signed.groupBy("signature")
        .agg(F.min("rep").alias("first"), F.max("rep").alias("last"), F.min(_scattered("rep")).alias("other"),
             F.count("*").alias("sets"))
        .where("first < last").select("signature", "first", _scattered("other").alias("other"), "sets")
    )
    sharing = kept(signed.join(groups.hint("shuffle_hash"), "signature"), "jaccard-sharing")
    many = sharing.where(F.col("sets") > FEW)
    crowd = many.where(F.col("sets") > BLOCK)
    pairs = kept(
        _bounded(_few_pairs(sharing.where(F.col("sets") <= FEW)).unionAll(_leader_pairs(many)).distinct(), of_class, shared, of),
        "jaccard-pairs",
    )
    found = kept(_linked(pairs, _sets(texts, _members(pairs), width), shared, of), "jaccard-links")
    joined = components(found)
    apart = kept(_apart_pairs(_open(many.where(F.col("sets") <= BLOCK), joined), of_class, shared, of), "jaccard-apart")
    if not apart.isEmpty():
        found = found.unionAll(kept(_linked(apart, _sets(texts, _members(apart), width), shared, of), "jaccard-links"))
        joined = components(found)
    members = kept(_families(_open(crowd, joined), of_class), "jaccard-open")
    if not members.isEmpty():
        facing = _in_blocks(members, F.lit(1 / BLOCK), "parity")
        alike = kept(facing.mapInArrow(_by_group(_alike(shared, of), KEYS, ["rep"]), "rep long").distinct(), "jaccard-alike")
        near = members.drop("parity").join(alike, "rep", "left_semi").join(_sets(texts, alike, width), "rep")
        weight = F.greatest(F.lit(1 / BLOCK), F.size("elements") / BLOCK_ELEMENTS)
        facing = _in_blocks(kept(near, "jaccard-near"), weight, "elements")
        more = facing.mapInArrow(_by_group(_compared(shared, of), KEYS, ["a", "b"]), "a long, b long")
        joined = components(found.unionAll(kept(more, "jaccard-more")))
    heads = joined.select(F.col("node").alias("rep"), "component")
    grouped = classes.join(heads, "rep", "left").select(
        "set_hash", F.coalesce("component", "rep").alias("component_id")
    )
    return shaped.join(grouped, "set_hash", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _scattered(name: str) -> Column:
    """A one-to-one change of a long that is its own inverse, one of ``ORDERS`` by signature: its least value is
    another set than the least id, and the same for many signatures of a group."""
    return F.col(name).bitwiseXOR(F.shiftrightunsigned(F.xxhash64(F.pmod("signature", F.lit(ORDERS))), 1))


def _pair(one: Column, two: Column) -> list[Column]:
    return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")]


def _few_pairs(sharing: DataFrame) -> DataFrame:
    """All pairs of signatures of at most ``FEW`` sets: a bounded number per row."""
    listed = sharing.groupBy("signature").agg(F.sort_array(F.collect_set("rep")).alias("reps"))
    pairs = F.flatten(F.transform("reps", lambda one, at: F.transform(
        F.slice("reps", at + 2, FEW), lambda two: F.struct(one.alias("a"), two.alias("b")))))
    return listed.select(F.explode(pairs).alias("pair")).select("pair.a", "pair.b")


def _leader_pairs(sharing: DataFrame) -> DataFrame:
    """A set and the leaders that most of its signatures name, at most ``LEADERS`` of them: a bounded number per set."""
    named = sharing.select("rep", F.explode(F.array("first", "other")).alias("leader")).where("rep <> leader")
    votes = named.groupBy("rep", "leader").agg(F.count("*").alias("votes"))
    ordered = F.sort_array(F.collect_list(F.struct("votes", "leader")), asc=False)
    top = votes.groupBy("rep").agg(F.slice(ordered, 1, LEADERS).alias("top"))
    return top.select("rep", F.explode("top.leader").alias("leader")).select(*_pair(F.col("rep"), F.col("leader")))


def _bounded(pairs: DataFrame, of_class: DataFrame, shared: int, of: int) -> DataFrame:
    """Pairs that sizes and parity bits do not rule out."""
    known = of_class.select("rep", F.col("n_shingles").alias("size"), "parity").dropDuplicates(["rep"])
    one, two = known.toDF("a", "size_a", "parity_a"), known.toDF("b", "size_b", "parity_b")
    close = F.least("size_a", "size_b") * of >= F.greatest("size_a", "size_b") * shared
    differing = sum((F.bit_count(F.col("parity_a")[i].bitwiseXOR(F.col("parity_b")[i])) for i in range(PARITY)), F.lit(0))
    bound = differing * (of + shared) <= (F.col("size_a") + F.col("size_b")) * (of - shared)
    return pairs.join(one, "a").join(two, "b").where(close & bound).select("a", "b")


def _members(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()


def _sets(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The sets of the wanted documents only; a doc_id that is repeated gives one."""
    chosen = texts.join(wanted.withColumnRenamed("rep", "doc_id").hint("shuffle_hash"), "doc_id", "left_semi")
    listed = chosen.mapInArrow(_listing(width), "rep long, elements array<long>")
    return kept(listed.dropDuplicates(["rep"]), "jaccard-elements")


def _linked(pairs: DataFrame, sets: DataFrame, shared: int, of: int) -> DataFrame:
    one, two = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    total = F.size("set_a") + F.size("set_b")
    return pairs.join(one, "a").join(two, "b").where(common * (of + shared) >= total * shared).select("a", "b")


def _open(sharing: DataFrame, joined: DataFrame) -> DataFrame:
    """Sets of signatures whose sets still lie in different components: signature, rep, component and the
    signature's lowest component."""
    heads = joined.select(F.col("node").alias("rep"), "component")
    placed = sharing.select("signature", "rep").join(heads, "rep", "left").select(
        "signature", "rep", F.coalesce("component", "rep").alias("component")
    )
    ends = placed.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return placed.join(ends.where("low < high").drop("high"), "signature")


def _known(of_class: DataFrame) -> DataFrame:
    return of_class.select("rep", F.col("n_shingles").alias("size"), "parity").dropDuplicates(["rep"])


def _tasks(rows: DataFrame) -> int:
    """Comparisons take long for their bytes, so the number of their tasks is set and not adapted."""
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _apart_pairs(open_: DataFrame, of_class: DataFrame, shared: int, of: int) -> DataFrame:
    """Pairs of different components that share a signature of at most ``BLOCK`` sets, as far as sizes and parity
    let them link."""
    rows = open_.select("signature", "rep", "component").join(_known(of_class), "rep").select(
        "signature", "rep", "component", "size", "parity"
    )
    grouped = rows.repartition(_tasks(rows), "signature").sortWithinPartitions("signature")
    return grouped.mapInArrow(_by_group(_alike_pairs(shared, of), ["signature"], ["a", "b"]), "a long, b long").distinct()


def _families(open_: DataFrame, of_class: DataFrame) -> DataFrame:
    """Members of signatures of more sets, with component, size and parity. Components that such a signature joins
    are one family."""
    rows = kept(open_.select("rep", "component", "low").distinct(), "jaccard-crowd")
    bridges = rows.select(F.col("component").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
    families = components(bridges).select(F.col("node").alias("component"), F.col("component").alias("family"))
    placed = rows.select("rep", "component").distinct().join(families, "component", "left")
    return placed.join(_known(of_class), "rep").select(
        "rep", "component", F.coalesce("family", "component").alias("family"), "size", "parity"
    )


def _in_blocks(members: DataFrame, weight: Column, payload: str) -> DataFrame:
    """Rows in which every set outside its family's largest component meets all sets of the family, a block of
    them against a block; sorted by pair of blocks. ``weight`` is a set's share of a block."""
    sizes = members.groupBy("family", "component").agg(F.count("*").alias("sets"), F.sum(weight).alias("blocks"))
    main = sizes.groupBy("family").agg(
        F.max(F.struct("sets", "component", "blocks")).alias("top"), F.sum("blocks").alias("all")
    ).select("family", F.col("top.component").alias("main"), F.ceil("top.blocks").cast("int").alias("inner"),
             F.ceil(F.col("all") - F.col("top.blocks") + 1e-6).cast("int").alias("outer"))
    marked = members.join(main, "family").withColumn("outside", F.col("component") != F.col("main"))
    own = F.when(F.col("outside"), F.col("outer")).otherwise(F.col("inner"))
    marked = marked.withColumn("block", F.pmod(F.xxhash64("rep"), own).cast("int"))

    def against(count: str, at: Callable[[Column], Column]) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(count) - 1), at)

    # Blocks of sets outside are numbered apart from those of the main component; i is a block outside.
    outer_pairs = against("outer", lambda j: F.struct(
        F.least("block", j).alias("i"), F.greatest("block", j).alias("j"), F.lit(False).alias("inner")))
    inner_as_i = against("inner", lambda j: F.struct(
        F.col("block").alias("i"), j.alias("j"), F.lit(True).alias("inner")))
    inner_as_j = against("outer", lambda i: F.struct(
        i.alias("i"), F.col("block").alias("j"), F.lit(True).alias("inner")))
    at = F.when(F.col("outside"), F.concat(outer_pairs, inner_as_i)).otherwise(inner_as_j)
    facing = marked.select("family", "rep", "component", "size", payload, F.explode(at).alias("at")).select(
        "family", "at.i", "at.j", "at.inner", "rep", "component", "size", payload
    )
    return facing.repartition(_tasks(members), *KEYS).sortWithinPartitions(*KEYS)


def _by_group(compare: Callable[..., list[np.ndarray]], by: list[str], names: list[str]):
    """Calls ``compare`` with reps, components, sizes, offsets and payload of each group of a sorted partition."""

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
        pending: list[pa.Table] = []
        last = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = list(zip(*[table.column(name).to_pylist() for name in by]))
            start = 0
            for at, key in enumerate(keys):
                if key != last:
                    pending.append(table.slice(start, at - start))
                    if last is not None:
                        yield pa.concat_tables(pending)
                    pending, start, last = [], at, key
            pending.append(table.slice(start))
        if last is not None:
            yield pa.concat_tables(pending)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            payload = block.column(block.num_columns - 1).combine_chunks()
            offsets = payload.offsets.to_numpy()
            found = compare(
                *[block.column(name).to_numpy() for name in ("rep", "component", "size")],
                offsets - offsets[0], payload.flatten().to_numpy(),
            )
            if len(found[0]):
                yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in found], names=names)

    return run


def _close(heads, sizes, payload, shared: int, of: int) -> Iterator[tuple[int, np.ndarray]]:
    """For 64 sets at a time, which sets of other components parity and size let link with them."""
    bits = payload.view(np.uint64).reshape(-1, PARITY)
    for at in range(0, len(heads), 64):
        part = slice(at, at + 64)
        differing = np.bitwise_count(bits[part, None] ^ bits[None]).sum(axis=2, dtype=np.int64)
        one, two = sizes[part, None], sizes[None]
        close = (differing * (of + shared) <= (one + two) * (of - shared)) & (heads[part, None] != heads[None])
        yield at, close & (np.minimum(one, two) * of >= np.maximum(one, two) * shared)


def _alike(shared: int, of: int):
    """Sets that may link with a set of another component."""

    def compare(reps, heads, sizes, offsets, payload) -> list[np.ndarray]:
        found = [close.any(axis=1) for _, close in _close(heads, sizes, payload, shared, of)]
        return [reps[np.concatenate(found)]]

    return compare


def _alike_pairs(shared: int, of: int):
    """Pairs of different components that may link, the smaller id first."""

    def compare(reps, heads, sizes, offsets, payload) -> list[np.ndarray]:
        made = []
        for at, close in _close(heads, sizes, payload, shared, of):
            one, two = np.nonzero(close)
            one, two = reps[one + at], reps[two]
            made.append((one[one < two], two[one < two]))
        return [np.concatenate([pair[side] for pair in made]) for side in (0, 1)]

    return compare


def _compared(shared: int, of: int):
    """Links that join the components of one pair of blocks; a component that is joined is not compared again."""

    def compare(reps, heads, sizes, offsets, payload) -> list[np.ndarray]:
        parents: dict[int, int] = {}

        def head(name: int) -> int:
            while parents.get(name, name) != name:
                name = parents[name]
            return name

        order = np.argsort(payload, kind="stable")
        values, owner = payload[order], np.repeat(np.arange(len(reps)), sizes)[order]
        links: list[tuple[int, int]] = []
        for place in range(len(reps)):
            wanted = payload[offsets[place]:offsets[place + 1]]
            starts, ends = np.searchsorted(values, wanted, "left"), np.searchsorted(values, wanted, "right")
            spans = ends - starts
            at = np.repeat(starts - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
            common = np.bincount(owner[at], minlength=len(reps))
            close = (common * (of + shared) >= (sizes + sizes[place]) * shared) & (heads != heads[place])
            close[: place + 1] = False
            for other in np.flatnonzero(close):
                one, two = head(int(heads[place])), head(int(heads[other]))
                if one != two:
                    parents[max(one, two)] = min(one, two)
                    links.append((int(reps[place]), int(reps[other])))
        return [np.array([link[side] for link in links], dtype=np.int64) for side in (0, 1)]

    return compare


def drop_near_copies(docs: DataFrame, width: int = 5, shared: int = 8, of: int = 10) -> DataFrame:
    """The rows of ``docs``, all columns, without those of a component's documents but the smallest doc_id. Rows
    without a doc_id stay."""
    found = kept(jaccard_components(docs, width, shared, of), "jaccard-components")
    dropped = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(dropped.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)
