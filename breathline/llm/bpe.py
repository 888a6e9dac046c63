"""Byte-level BPE by DuckDB recursive queries inside each partition.

Encoding: a text is split into the pattern's matches; matches that a worker has not met yet become rows of
(word, position, token) in each round of a recursive query: they are joined with their right neighbours to the
merge table, and the word's leftmost pair of minimum rank is contracted, until no pair is left. Decoding: ids
become the vocabulary's pieces, and these are aggregated in their order.

A long match is contracted at many places in one round. It is divided into buckets of bytes twice as long as the
longest token, and a bucket's leftmost pair of minimum rank is contracted if those of the buckets beside it come
later. Whatever could touch that pair before its turn is a token that reaches it, so all its bytes lie in these
buckets, and the first contraction among them would be of a pair that is there now and comes earlier: there is
none. All places of the match's minimum rank are contracted too, those that overlap from the left, if the token
they make is calm: if no pair with it has a lower rank, so that none can come in between. Rounds are thus bounded
by what a few buckets hold, or by the different tokens of a periodic match, not by its length.

Every task works on slices of its own partition, so nothing is shuffled.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from breathline.llm.base import documents, slices

# Bytes of text and ids that are worked on at once, words and bytes in one recursive query, memory of a worker's
# DuckDB, and bytes of all words that a worker remembers (an entry of a dictionary takes some 200 beside them),
# kinds of matches, and different pairs of bytes in a long one that make it a varied one.
SLICE_BYTES = 2 << 20
WORDS_AT_ONCE = 20_000
BYTES_AT_ONCE = 1 << 20
QUERY_MEMORY = "128MB"
PLAIN, VARIED, QUIET = "plain", "varied", "quiet"
LEAST_PAIRS = 64
REMEMBERED_BYTES = 80 << 20
ENTRY_BYTES = 200

# Marks that end a word as one match; the apostrophe is not one of them, as it may begin a match with letters.
MARKS = "!#$%&*,.:;?@|"
ADJACENT = re.compile(r"\s\s")

ENCODED = "doc_id long, n_tokens long, ids binary"
DECODED = "doc_id long, ids binary, decoded binary"

# Only the last state of a word is kept; a word without a pair to contract leaves the recursion.
CONTRACT = """
WITH RECURSIVE contracted(word, ids) USING KEY (word) AS (
  SELECT word, ids FROM started
  UNION
  SELECT c.word, list_concat(list_concat(ids[:(best & 4294967295) - 1], [(best >> 32)::INTEGER]),
                             ids[(best & 4294967295) + 2:])
  FROM contracted c JOIN (
    SELECT word, min((merged::BIGINT << 32) | pos) AS best
    FROM (
      SELECT word, unnest(ids) AS token, unnest(ids[2:]) AS after, generate_subscripts(ids, 1) AS pos FROM contracted
    ) rows JOIN merges ON pair = (token::BIGINT << 32) | after
    GROUP BY word
  ) lowest USING (word)
)
SELECT word, ids FROM contracted ORDER BY word
"""

# The same with a token's first byte beside it, and many contractions a round.
CONTRACT_LONG = """
WITH RECURSIVE contracted(word, ids, starts) USING KEY (word) AS (
  SELECT word, ids, range(len(ids))::INTEGER[] FROM started
  UNION
  SELECT word, list(coalesce(merged, token) ORDER BY start), list(start ORDER BY start)
  FROM (
    WITH rows AS (
      SELECT word, unnest(ids) AS token, unnest(starts) AS start, unnest(ids[2:]) AS after,
             generate_subscripts(ids, 1) AS pos
      FROM contracted
    ), able AS (
      SELECT word, start, pos, merged, calm, min(merged) OVER (PARTITION BY word) AS lowest
      FROM rows JOIN merges ON pair = (token::BIGINT << 32) | after
    ), runs AS (
      SELECT word, start, merged, pos, pos - row_number() OVER (PARTITION BY word ORDER BY pos) AS run
      FROM able WHERE merged = lowest AND calm
    ), buckets AS (
      SELECT word, start // $bucket AS bucket, min((merged::BIGINT << 32) | start) AS best FROM able GROUP BY ALL
    ), beside AS (
      SELECT *, lag(bucket) OVER w AS bucket_before, lag(best) OVER w AS best_before,
             lead(bucket) OVER w AS bucket_after, lead(best) OVER w AS best_after
      FROM buckets WINDOW w AS (PARTITION BY word ORDER BY bucket)
    ), chosen AS (
      SELECT word, start, merged FROM runs
      QUALIFY row_number() OVER (PARTITION BY word, run ORDER BY pos) % 2 = 1
      UNION
      SELECT word, (best & 4294967295)::INTEGER, (best >> 32)::INTEGER FROM beside
      WHERE (bucket_before IS DISTINCT FROM bucket - 1 OR best < best_before)
        AND (bucket_after IS DISTINCT FROM bucket + 1 OR best < best_after)
    )
    SELECT rows.word, rows.start, token, merged, lag(merged) OVER w AS consumed,
           count(merged) OVER (PARTITION BY rows.word) AS done
    FROM rows LEFT JOIN chosen ON chosen.word = rows.word AND chosen.start = rows.start
    WINDOW w AS (PARTITION BY rows.word ORDER BY rows.start)
  )
  WHERE consumed IS NULL AND done > 0
  GROUP BY word
)
SELECT word, ids FROM contracted ORDER BY word
"""

# A list's values are aggregated in their order.
DECODE = """
SELECT doc, unhex(list_aggregate(list_transform(ids, lambda token: pieces[token + 1]), 'string_agg', '')) AS decoded
FROM listed, vocabulary
ORDER BY doc
"""


class Codec:
    """The tables of one rank file, in a DuckDB of this worker's memory; each is made when it is needed."""

    def __init__(self, path: str, pattern: str, spaces_begin: bool):
        import duckdb
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.matches = regex.compile(pattern).findall
        self.spaces_begin = spaces_begin
        # Ids of words that follow a space (kept without it) and of other matches: those met of late, and those
        # before them. What is met again stays.
        self.spaced: list[dict[str, bytes]] = [{}, {}]
        self.plain: list[dict[str, bytes]] = [{}, {}]
        self.held = 0
        self.base = np.array([self.ranks[bytes([byte])] for byte in range(256)], dtype=np.int32)
        self.bucket = 2 * max(map(len, self.ranks))
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": QUERY_MEMORY, "temp_directory": ""})
        self.made: set[str] = set()

    def _tables(self, name: str) -> None:
        if name in self.made:
            return
        self.made.add(name)
        ranks = self.ranks
        if name == "merges":
            pairs, merged, restless = [], [], set()
            for token, rank in ranks.items():
                for at in range(1, len(token)):
                    left, right = ranks.get(token[:at]), ranks.get(token[at:])
                    if left is not None and right is not None:
                        pairs.append(left << 32 | right)
                        merged.append(rank)
                        restless.update(part for part in (left, right) if part > rank)
            merges = pa.table({
                "pair": pa.array(pairs, pa.int64()), "merged": pa.array(merged, pa.int32()),
                "calm": pa.array([rank not in restless for rank in merged], pa.bool_()),
            })
            self.db.register("given", merges)
            self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
        else:
            pieces: list[str | None] = [None] * (max(ranks.values()) + 1)
            for token, rank in ranks.items():
                pieces[rank] = token.hex()
            self.db.register("given", pa.table({"pieces": [pieces]}))
            self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        self.db.unregister("given")

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts. Where the pattern is one by which a single space between two visible characters
        always begins a match, a text without adjacent white space is its first word and the words that each
        follow a space; other texts are split into matches at once."""
        split, whole = [], []
        for text in texts:
            if self.spaces_begin and ADJACENT.search(text) is None:
                first, *spaced = text.split(" ")
                whole.append(self.matches(first))
            else:
                spaced = []
                whole.append(self.matches(text))
            split.append(spaced)
        self._recall(self.spaced, set().union(*split), self._learn_spaced)
        self._recall(self.plain, set().union(*whole), self._learn)
        spaced, plain = self.spaced[0].__getitem__, self.plain[0].__getitem__
        made = [b"".join([*map(plain, start), *map(spaced, rest)]) for start, rest in zip(whole, split)]
        if self.held > REMEMBERED_BYTES // 2:
            for memory in (self.spaced, self.plain):
                memory[:] = [{}, memory[0]]
            self.held = 0
        return made

    def _keep(self, memory: list[dict[str, bytes]], words: list[str], ids: list[bytes]) -> None:
        memory[0].update(zip(words, ids))
        self.held += sum(map(len, words)) + sum(map(len, ids)) + ENTRY_BYTES * len(words)

    def _recall(self, memory: list[dict[str, bytes]], wanted: set[str], learn: Callable[[set[str]], None]) -> None:
        known, older = memory
        fresh = wanted.difference(known)
        again = list(older.keys() & fresh)
        self._keep(memory, again, [older[unit] for unit in again])
        if len(fresh) > len(again):
            learn(fresh.difference(again))

    def _learn_spaced(self, units: set[str]) -> None:
        """Units that follow a space. Letters are one match with it, and a run of marks after them another."""
        known, single = self.spaced[0], [unit for unit in units if unit.isalpha()]
        self._keep(self.spaced, single, self._encoded([(" " + unit).encode() for unit in single]))
        marked, rest = [], {}
        for unit in units.difference(single):
            letters = unit.rstrip(MARKS)
            if letters.isalpha():
                marked.append((unit, letters, unit[len(letters):]))
            else:
                rest[unit] = self.matches(" " + unit)
        self._recall(self.spaced, {letters for _, letters, _ in marked}, self._learn_spaced)
        wanted = set().union(*rest.values()).union([marks for _, _, marks in marked])
        self._recall(self.plain, wanted, self._learn)
        plain = self.plain[0]
        self._keep(self.spaced, [unit for unit, _, _ in marked], [known[one] + plain[marks] for _, one, marks in marked])
        self._keep(self.spaced, list(rest), [b"".join([plain[word] for word in words]) for words in rest.values()])

    def _learn(self, words: set[str]) -> None:
        listed = list(words)
        self._keep(self.plain, listed, self._encoded([word.encode() for word in listed]))

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        """Ids of single matches: a token of the vocabulary is itself, others are contracted."""
        self._tables("merges")
        ids = [rank if rank is None else rank.to_bytes(4, "little") for rank in map(self.ranks.get, words)]
        many = CONTRACT_LONG.replace("$bucket", str(self.bucket))
        kinds = [None if one is not None else self._kind(word) for one, word in zip(ids, words)]
        for kind, query in ((PLAIN, CONTRACT), (VARIED, many), (QUIET, many.replace("AND calm", ""))):
            todo = [at for at, one in enumerate(kinds) if one == kind]
            for some in _portions(todo, words):
                for at, found in zip(some, self._contracted([words[at] for at in some], query)):
                    ids[at] = found
        return ids

    def _kind(self, word: bytes) -> str:
        """How a match is contracted. In a long one with many pairs of bytes, buckets have minima of their own. In one
        with few pairs, minima are equal everywhere and wait for each other, unless all of its own tokens are calm."""
        if len(word) <= 8 * self.bucket:
            return PLAIN
        if len(set(zip(word, word[1:]))) >= LEAST_PAIRS:
            return VARIED
        ranks, longest = self.ranks, self.bucket // 2
        parts = {word[at:at + size] for size in range(2, longest + 1) for at in range(len(word) - size + 1)}
        for token in parts & ranks.keys():
            for at in range(1, len(token)):
                if max(ranks.get(token[:at], -1), ranks.get(token[at:], -1)) > ranks[token]:
                    return PLAIN
        return QUIET

    def _contracted(self, words: list[bytes], query: str) -> list[bytes]:
        offsets = np.zeros(len(words) + 1, dtype=np.int32)
        np.cumsum(list(map(len, words)), out=offsets[1:])
        tokens = self.base[np.frombuffer(b"".join(words), dtype=np.uint8)]
        started = {"word": np.arange(len(words), dtype=np.int32), "ids": _lists(offsets, tokens)}
        self.db.register("started", pa.table(started))
        ids = self.db.sql(query).to_arrow_table().column("ids").combine_chunks()
        values = ids.values.to_numpy().astype("<u4").tobytes()
        ends = (4 * ids.offsets.to_numpy()).tolist()
        return [values[start:end] for start, end in zip(ends, ends[1:])]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each list of ids; an id that the vocabulary lacks adds nothing."""
        self._tables("vocabulary")
        offsets = np.zeros(len(ids) + 1, dtype=np.int32)
        np.cumsum([len(one) // 4 for one in ids], out=offsets[1:])
        tokens = np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int64)
        listed = {"doc": np.arange(len(ids), dtype=np.int32), "ids": _lists(offsets, tokens)}
        self.db.register("listed", pa.table(listed))
        found = self.db.sql(DECODE).to_arrow_table().column("decoded").to_pylist()
        return [one or b"" for one in found]


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _portions(chosen: list[int], words: list[bytes]) -> Iterator[list[int]]:
    """Runs of words for one query each; a longer word comes alone."""
    some, size = [], 0
    for at in chosen:
        if some and (len(some) == WORDS_AT_ONCE or size + len(words[at]) > BYTES_AT_ONCE):
            yield some
            some, size = [], 0
        some.append(at)
        size += len(words[at])
    if some:
        yield some


@lru_cache(maxsize=1)
def codec(path: str, pattern: str, spaces_begin: bool = False) -> Codec:
    """One per worker process: what it has learnt serves the next tasks too."""
    return Codec(path, pattern, spaces_begin)


def _spaces_begin(pattern: str) -> bool:
    """Whether a single space always begins a match: it does by the pattern that comes with the vocabularies, and
    of other patterns nothing is known."""
    import public_tokenizers

    return pattern == public_tokenizers.PATTERN


def _ids(ids: list[bytes]) -> list[pa.Array]:
    return [pa.array([len(one) // 4 for one in ids], pa.int64()), pa.array(ids, pa.binary())]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and the ids (little-endian unsigned 32-bit) of every whole text, by any pattern.

    Null and empty texts have no ids. Repeated rows are encoded each; other columns are ignored; an empty table
    gives no rows. Special tokens are ordinary text. A match of any length takes rounds by what a few buckets of
    it hold, each over the match; one that repeats a few bytes takes a round for each contraction, unless its tokens
    are calm.
    """
    known_pattern = _spaces_begin(pattern)

    def encode_partition(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(path, pattern, known_pattern)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                ids = known.ids(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *_ids(ids)], names=["doc_id", "n_tokens", "ids"])

    return documents(docs).mapInArrow(encode_partition, ENCODED)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids and the decoded bytes of rows with ``doc_id`` and ``ids``. Null ids count as none, and an id that
    the vocabulary lacks adds nothing; repeated rows are decoded each; an empty table gives no rows."""

    def decode_partition(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(path, pattern)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                decoded = known.decode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(decoded, pa.binary())],
                    names=["doc_id", "ids", "decoded"],
                )

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("ids", F.lit(b"")).alias("ids"))
    return rows.mapInArrow(decode_partition, DECODED)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids and the bytes decoded from these ids, of every whole text: ``encode`` and ``decode`` in
    one worker, which holds one codec. Every case as there."""
    known_pattern = _spaces_begin(pattern)

    def both(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(path, pattern, known_pattern)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                ids = known.ids(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *_ids(ids), pa.array(known.decode(ids), pa.binary())],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    return documents(docs).mapInArrow(both, f"{ENCODED}, decoded binary")
