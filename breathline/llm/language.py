"""Language of texts that may switch between languages: a linear-chain conditional random field labels words.

A word's features are its character n-grams, beginnings and endings, the word itself and the languages in whose
lexicon it stands; learned transitions say how likely neighbouring words differ in language. Forward-backward
gives the probability of each language at each word of a whole text, and the text's language is the one with the
largest mean.

Words are not labelled, documents are. The field learns from sequences that are put together from runs of words
of several documents, so that transitions are seen, and once more without the runs that the first field finds to
be in another language than their document. The lexicon comes from other documents than the runs do.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from breathline.llm.base import documents, kept, slices

# Documents of each language that are learnt from (half of them for the lexicon) at most; words of a run, runs of a
# sequence; words of each language in the lexicon.
SAMPLE = 1200
RUN = 24
RUNS = 4
LEXICON = 2000
LEAST_TIMES = 2
UNKNOWN = "und"

# Rounds of the optimiser before and after runs have left, its step, and the weight of large parameters.
FIRST_ROUNDS, ROUNDS = 25, 60
STEP = 0.2
RIDGE = 2e-3
# A run leaves the sample if another language holds more than this share of it.
ELSEWHERE = 0.6

# Bytes of text that are labelled at once, words of a block, blocks whose words are looked at together, new words
# whose features are, words whose potentials a worker remembers.
SLICE_BYTES = 2 << 20
BLOCK = 32
BLOCKS_AT_ONCE = 1 << 14
WORDS_AT_ONCE = 1 << 14
REMEMBERED = 300_000

WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased; none if the text has no letter."""
    return WORDS.findall(text.lower()) if any(map(str.isalpha, text)) else []


def features_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all the words at once, as pairs: the number of the word, and the feature's code.

    With a mark before and after each word, they are its character n-grams of one to three, beginnings and endings
    of three and four letters, and the word itself. An n-gram's code is its code points beside each other, so no
    two share one; the others are hashes below zero.
    """
    points = np.frombuffer(("\x01" + "\x02\x01".join(words) + "\x02").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(points)) - starts[owner]
    left = sizes[owner] - place
    here = np.concatenate([points, np.zeros(4, dtype="<u4")]).astype(np.int64)
    count = len(points)
    owners, codes = [owner], [here[:count] << 42]
    pairs = codes[0] | (here[1:count + 1] << 21)
    for width, made in ((2, pairs), (3, pairs | here[2:count + 2])):
        owners.append(owner[left >= width])
        codes.append(made[left >= width])
    unsigned, factor = here.astype(np.uint64), np.uint64(0x9E3779B97F4A7C15)
    longer = np.flatnonzero(sizes > 5)
    for kind, width in enumerate((4, 5, 4, 5), start=1):
        begin = starts[longer] + (sizes[longer] - width if kind > 2 else 0)
        mixed = np.full(len(longer), kind, dtype=np.uint64)
        for step in range(width):
            mixed = (mixed + unsigned[begin + step]) * factor
            mixed ^= mixed >> np.uint64(29)
        owners.append(longer)
        codes.append(_below_zero(mixed))
    powers = np.cumprod(np.full(int(sizes.max(initial=1)), factor, dtype=np.uint64))
    whole = np.add.reduceat(unsigned[:count] * powers[place], starts)
    owners.append(np.arange(len(words)))
    codes.append(_below_zero(whole ^ (whole >> np.uint64(31))))
    return np.concatenate(owners), np.concatenate(codes)


def _below_zero(hashes: np.ndarray) -> np.ndarray:
    return (hashes | np.uint64(1 << 63)).view(np.int64)


class Field:
    """Weights of features and of transitions. The label before a text's first word is free."""

    def __init__(self, labels: list[str], lexicon: dict[str, int], codes: np.ndarray):
        self.token = uuid.uuid4().hex
        self.labels, self.lexicon, self.codes = labels, lexicon, codes
        # After the learnt features (codes in order) come the languages' lexicons; all else weighs nothing.
        self.weights = np.zeros((len(codes) + len(labels), len(labels)))
        self.transitions = np.zeros((len(labels), len(labels)))

    def rows_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a word's number and a row of the weights."""
        owner, found = features_of(words)
        rows = np.minimum(np.searchsorted(self.codes, found), max(len(self.codes) - 1, 0))
        known = self.codes[rows] == found if len(self.codes) else np.zeros(len(found), dtype=bool)
        stands = [(at, self.lexicon[word]) for at, word in enumerate(words) if word in self.lexicon]
        listed = np.array(stands, dtype=np.int64).reshape(-1, 2)
        return (
            np.concatenate([owner[known], listed[:, 0]]),
            np.concatenate([rows[known], len(self.codes) + listed[:, 1]]),
        )

    def potentials(self, words: list[str]) -> np.ndarray:
        """exp of each word's sums of weights, the largest being 1."""
        return _exp(self.sums(*self.rows_of(words), len(words)))

    def sums(self, owner: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
        labels = range(len(self.labels))
        return np.stack([np.bincount(owner, self.weights[rows, label], count) for label in labels], axis=1)


def _exp(sums: np.ndarray) -> np.ndarray:
    return np.exp(np.maximum(sums - sums.max(axis=1, keepdims=True), -200.0))


def _scaled(values: np.ndarray) -> np.ndarray:
    return values / values.sum(axis=tuple(range(1, values.ndim)), keepdims=True)


def posteriors(potentials: np.ndarray, transitions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Probability of each label at each word, by forward-backward over whole sequences.

    ``potentials`` has the words of all sequences after one another. Sequences are cut into blocks of ``BLOCK`` words; the
    product of a block's matrices carries what comes from one end to the other, so that a long sequence takes a
    step per block and all blocks are worked on together. The result is that of one pass over the sequence.
    """
    moves = np.exp(transitions - transitions.max())
    count = moves.shape[0]
    blocks = -(-lengths // BLOCK)
    first = np.cumsum(blocks) - blocks
    total = int(blocks.sum())
    place = np.arange(total) - np.repeat(first, blocks)
    begins = np.repeat(np.cumsum(lengths) - lengths, blocks) + place * BLOCK
    sizes = np.minimum(np.repeat(lengths, blocks) - place * BLOCK, BLOCK)
    opening = place == 0

    # Only blocks that do not end their sequence carry anything on; they are full.
    carrying = np.ones((total, count, count)) / count
    inner = np.flatnonzero(np.repeat(blocks, blocks) - 1 > place)
    for at in range(0, len(inner), BLOCKS_AT_ONCE):
        chosen = inner[at:at + BLOCKS_AT_ONCE]
        made = np.where(opening[chosen][:, None, None], np.eye(count), moves) * potentials[begins[chosen]][:, None, :]
        for step in range(1, BLOCK):
            made = _scaled((made @ moves) * potentials[begins[chosen] + step][:, None, :])
        carrying[chosen] = made

    # What reaches each block from the words before it and after it, block by block of the sequences that have one.
    before, after = np.full((total, count), 1.0 / count), np.full((total, count), 1.0 / count)
    order = np.argsort(-blocks, kind="stable")
    longest = int(blocks.max(initial=0))
    having = np.searchsorted(-blocks[order], -np.arange(longest), side="left")  # sequences with a block of that number
    for number in range(1, longest):
        here = first[order[:having[number]]] + number
        before[here] = _scaled(np.einsum("si,sij->sj", before[here - 1], carrying[here - 1]))
    ending = first + blocks - 1
    for back in range(1, longest):
        here = ending[order[:having[back]]] - back
        if back == 1:  # the block behind ends its sequence: its words are passed one by one
            after[here] = _passed(potentials, moves, begins[here + 1], sizes[here + 1], after[here + 1])
        else:
            after[here] = _scaled(np.einsum("sij,sj->si", carrying[here + 1], after[here + 1]))

    found = np.empty_like(potentials)
    for at in range(0, total, BLOCKS_AT_ONCE):
        part = slice(at, at + BLOCKS_AT_ONCE)
        _inside(potentials, moves, begins[part], sizes[part], opening[part], before[part], after[part], found)
    return found


def _passed(potentials: np.ndarray, moves: np.ndarray, begins: np.ndarray, sizes: np.ndarray, after: np.ndarray) -> np.ndarray:
    """What the last word before a block learns from the block's words and what follows them."""
    known = after
    for step in range(int(sizes.max(initial=0)) - 1, -1, -1):
        live = sizes > step
        words = np.where(live, begins + step, 0)
        known = np.where(live[:, None], _scaled((potentials[words] * known) @ moves.T), known)
    return known


def _inside(
    potentials: np.ndarray, moves: np.ndarray, begins: np.ndarray, sizes: np.ndarray, opening: np.ndarray,
    before: np.ndarray, after: np.ndarray, found: np.ndarray,
) -> None:
    """Writes the probabilities at the words of some blocks, given what reaches these from both sides."""
    longest = int(sizes.max(initial=0))
    forward = np.empty((longest, *before.shape))
    state = before
    for step in range(longest):
        words = np.where(sizes > step, begins + step, 0)
        arriving = state @ moves
        if step == 0:
            arriving = np.where(opening[:, None], 1.0, arriving)
        state = np.where((sizes > step)[:, None], _scaled(arriving * potentials[words]), state)
        forward[step] = state
    known = after
    for step in range(longest - 1, -1, -1):
        live = sizes > step
        words = begins[live] + step
        found[words] = _scaled(forward[step][live] * known[live])
        known = known.copy()
        known[live] = _scaled((potentials[words] * known[live]) @ moves.T)


class Learner:
    """Fits a field to labelled runs of words. Sequences are runs in the order of a hash, ``RUNS`` at a time."""

    def __init__(self, labels: list[str], lexicon: dict[str, int], runs: list[tuple[int, list[str]]]):
        vocabulary = {word: at for at, word in enumerate(sorted({word for _, words in runs for word in words}))}
        codes, times = np.unique(features_of(list(vocabulary))[1], return_counts=True)
        self.field = Field(labels, lexicon, codes[times >= LEAST_TIMES])
        self.words = len(vocabulary)
        self.owner, self.flat = self.field.rows_of(list(vocabulary))
        self.ids = [np.array([vocabulary[word] for word in words], dtype=np.int64) for _, words in runs]
        self.kinds = [np.full(len(words), label, dtype=np.int64) for label, words in runs]

    def fit(self, chosen: list[int], rounds: int) -> None:
        field, count = self.field, len(self.field.labels)
        ids = np.concatenate([self.ids[run] for run in chosen])
        kinds = np.concatenate([self.kinds[run] for run in chosen])
        lengths = np.add.reduceat([len(self.ids[run]) for run in chosen], np.arange(0, len(chosen), RUNS))
        inside = np.ones(len(ids), dtype=bool)
        inside[np.cumsum(lengths)[:-1]] = False
        inside[0] = False
        later = np.flatnonzero(inside)
        observed = np.eye(count)[kinds]
        seen = np.zeros((count, count))
        np.add.at(seen, (kinds[later - 1], kinds[later]), 1.0)
        parameters = [field.weights, field.transitions]
        moments = [(np.zeros_like(one), np.zeros_like(one)) for one in parameters]
        for turn in range(1, rounds + 1):
            potentials = _exp(field.sums(self.owner, self.flat, self.words))[ids]
            expected, pairs = _expected(potentials, field.transitions, lengths, later)
            missing = observed - expected
            by_word = np.stack([np.bincount(ids, missing[:, one], self.words) for one in range(count)], axis=1)
            slopes = [
                np.stack([np.bincount(self.flat, by_word[self.owner, one], len(field.weights)) for one in range(count)], axis=1),
                seen - pairs,
            ]
            for values, slope, (mean, square) in zip(parameters, slopes, moments):
                slope = slope / len(ids) - RIDGE * values / len(ids) ** 0.5
                mean += 0.1 * (slope - mean)
                square += 0.01 * (slope * slope - square)
                values += STEP * (mean / (1 - 0.9 ** turn)) / (np.sqrt(square / (1 - 0.99 ** turn)) + 1e-6)

    def at_home(self) -> list[int]:
        """Runs that are mostly in the language of their document."""
        sums = self.field.sums(self.owner, self.flat, self.words)
        lengths = np.array([len(run) for run in self.ids])
        found = posteriors(_exp(sums)[np.concatenate(self.ids)], self.field.transitions, lengths)
        means = np.add.reduceat(found, np.cumsum(lengths) - lengths, axis=0) / lengths[:, None]
        return [run for run, kinds in enumerate(self.kinds) if 1 - means[run, kinds[0]] <= ELSEWHERE]


def _expected(potentials: np.ndarray, transitions: np.ndarray, lengths: np.ndarray, later: np.ndarray):
    """Probabilities of labels at words, and expected numbers of transitions to the words ``later``."""
    moves = np.exp(transitions - transitions.max())
    begins = np.cumsum(lengths) - lengths
    forward, backward = np.empty_like(potentials), np.empty_like(potentials)
    state = known = np.full((len(lengths), potentials.shape[1]), 1.0)
    for step in range(int(lengths.max())):
        live = np.flatnonzero(lengths > step)
        words = begins[live] + step
        state = state.copy()
        state[live] = _scaled(potentials[words] * (1.0 if step == 0 else state[live] @ moves))
        forward[words] = state[live]
    for step in range(int(lengths.max()) - 1, -1, -1):
        live = np.flatnonzero(lengths > step)
        words = begins[live] + step
        backward[words] = known[live]
        known = known.copy()
        known[live] = _scaled((potentials[words] * known[live]) @ moves.T)
    joint = forward[later - 1][:, :, None] * moves * (potentials[later] * backward[later])[:, None, :]
    return _scaled(forward * backward), _scaled(joint).sum(axis=0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Documents that may be learnt from: doc_id, text, lang, at most ``sample`` of each language, those whose ids
    have the least hashes. Ids are chosen before texts are read; of several rows of one id the least counts."""
    usable = F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    rows = docs.where(usable).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    least = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = rows.select("lang", "doc_id").distinct().withColumn("nth", F.row_number().over(least)).where(F.col("nth") <= sample)
    chosen = kept(ids.groupBy("doc_id").agg(F.min("lang").alias("lang")), "language-sample")
    return kept(
        rows.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text")),
        "language-training",
    )


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One run of words from a place in each text that its id decides."""
    for batch in batches:
        runs = []
        for place, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            words = words_of(text or "")
            start = place % max(len(words) - RUN + 1, 1)
            runs.append(words[start:start + RUN])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(runs, pa.list_(pa.string()))], names=["place", "lang", "words"]
        )


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each language that a word occurs in."""
    for batch in batches:
        counts: Counter[tuple[str, str]] = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.update([(lang, word) for word in set(words_of(text or ""))])
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang for lang, _ in counts], pa.string()), pa.array([word for _, word in counts], pa.string()),
             pa.array(list(counts.values()), pa.int64())],
            names=["lang", "word", "times"],
        )


def lexicon_of(training: DataFrame, labels: list[str], entries: int = LEXICON) -> dict[str, int]:
    """For each language the words that occur in most of its documents and at least nine times as seldom in
    those of each other. The driver gets ``entries`` words a language."""
    sizes = dict(training.groupBy("lang").count().collect())
    counted = training.select("lang", "text").mapInArrow(_counted, "lang string, word string, times long")
    by_word = counted.groupBy("word").agg(*[
        (F.sum(F.when(F.col("lang") == lang, F.col("times")).otherwise(0)) / sizes.get(lang, 1)).alias(f"share{at}")
        for at, lang in enumerate(labels)
    ], F.sum("times").alias("times")).where(F.col("times") >= LEAST_TIMES)
    parts = []
    for at in range(len(labels)):
        others = [F.col(f"share{other}") for other in range(len(labels)) if other != at]
        rival = reduce(F.greatest, others) if len(others) > 1 else (others or [F.lit(0.0)])[0]
        parts.append(
            by_word.where(F.col(f"share{at}") > 9 * rival).orderBy(F.desc(f"share{at}"), "word").limit(entries)
            .select("word", F.lit(at).alias("at"))
        )
    return dict(map(tuple, reduce(DataFrame.unionAll, parts).collect()))


def train(docs: DataFrame, sample: int = SAMPLE) -> Field | None:
    """A field learnt from a bounded sample of the documents whose language is known; None without any."""
    training = training_rows(docs, sample)
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0
    place = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1 << 31)).alias("place")
    labels = sorted(row[0] for row in training.select("lang").distinct().collect())
    if not labels:
        return None
    drawn = training.where(half).select(place, "lang", "text").mapInArrow(_runs, "place long, lang string, words array<string>")
    runs = [(labels.index(lang), words) for _, lang, words in sorted(tuple(row) for row in drawn.collect()) if words]
    learner = Learner(labels, lexicon_of(training.where(~half), labels), runs or [(0, ["a"])])
    everything = list(range(len(learner.ids)))
    learner.fit(everything, FIRST_ROUNDS)
    learner.fit(learner.at_home() or everything, ROUNDS)
    return learner.field


class _Memory(dict):
    """Row of a word's potentials, of the words a worker has met with one field."""

    def __init__(self, field: Field):
        super().__init__()
        self.field, self.waiting = field, []
        self.table = np.ones((0, len(field.labels)))

    def __missing__(self, word: str) -> int:
        self.waiting.append(word)
        self[word] = found = len(self)
        return found

    def ids_of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))

    def potentials(self) -> np.ndarray:
        if self.waiting:
            added = [
                self.field.potentials(self.waiting[at:at + WORDS_AT_ONCE]) for at in range(0, len(self.waiting), WORDS_AT_ONCE)
            ]
            self.table, self.waiting = np.concatenate([self.table, *added]), []
        return self.table

    def shorten(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()
            self.table = self.table[:0]


_memories: dict[str, _Memory] = {}


def _memory(field: Field) -> _Memory:
    """That of this worker, which lives as long as one field is in use."""
    if field.token not in _memories:
        _memories.clear()
        _memories[field.token] = _Memory(field)
    return _memories[field.token]


def label_words(texts: list[str], memory: _Memory) -> list[np.ndarray]:
    """For each text the probability of each language at each of its words."""
    ids = [memory.ids_of(words_of(text)) for text in texts]
    lengths = np.array([len(one) for one in ids], dtype=np.int64)
    found = posteriors(memory.potentials()[np.concatenate(ids)], memory.field.transitions, lengths[lengths > 0])
    memory.shorten()
    return np.split(found, np.cumsum(lengths)[:-1])


def identify(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, lang_pred, score and words of every row by its whole text: the language with the largest mean
    probability over the words (ties: the first by name), that mean, and how many words there are.

    ``und`` with score 0 where the text is null or has no letter, or where no language was learnt. Repeated rows are
    labelled each, other columns (of whatever name) are ignored, an empty table gives no rows.
    """

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                texts = part.column(1).to_pylist()
                made = [(UNKNOWN, 0.0, 0)] * len(texts)
                if field is not None:
                    for at, found in enumerate(label_words(texts, _memory(field))):
                        if len(found):
                            means = found.mean(axis=0)
                            best = int(means.argmax())
                            made[at] = (field.labels[best], min(float(means[best]), 1.0), len(found))
                named, score, words = zip(*made)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(named, pa.string()), pa.array(score, pa.float64()), pa.array(words, pa.int64())],
                    names=["doc_id", "lang_pred", "score", "words"],
                )

    return documents(docs).mapInArrow(label, "doc_id long, lang_pred string, score double, words long")


def predict_language(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    Learns from texts and languages of rows that are not held out, at most ``sample`` documents of each language; a
    null doc_id is neither held out nor learnt from. Every other case as in ``identify``.
    """
    return identify(docs, train(docs, sample)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
