"""Toxicity: gradient-boosted trees over dense features of the whole text, calibrated by isotonic regression.

The lexicon has fixed words and what the labelled training rows add to them: words and beginnings of words that
are far more frequent in toxic documents. The rows that train trees are measured with a lexicon that has not
seen them (three parts, each with the lexicon of the other two); the trees learn from two parts and the
calibration from the third.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from breathline.llm.base import kept

# Labelled rows of each class that train: at most this many, chosen by a hash of doc_id.
SAMPLE = 5000
# Lexicon entries at most, documents an entry must occur in, and the least log ratio of document shares.
ENTRIES = 3000
LEAST_DOCUMENTS = 4
LEAST_RATIO = 1.5
STRONG = 4.0
PARTS = 3
CUT = 0.7
# Texts measured together, and tokens whose weight a worker remembers.
ROWS_AT_ONCE = 1000
REMEMBERED = 200_000

# Insults in English, and words that address somebody in English, French, German and Spanish.
INSULTS = ("clown", "disgusting", "dumb", "idiot", "imbecile", "loser", "moron", "pathetic", "scum", "stupid",
           "trash", "vermin", "worthless")
SECOND_PERSON = ("dein", "deine", "dich", "dir", "du", "euch", "ihr", "ta", "te", "tes", "ti", "toi", "ton", "tu",
                 "tus", "u", "ur", "usted", "ustedes", "votre", "vos", "vous", "you", "your", "yours", "yourself")
# Characters that stand for letters in disguised words.
DISGUISE = str.maketrans("013457@$", "oieastas")

TOKENS = re.compile(r"[\w@$]+")
CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]")
MASKED = re.compile(r"\w[*#@$%&!]+\w")
REPEATED = re.compile(r"(\w)\1\1\1")

FEATURES = ("insults", "strong", "moderate", "weight", "heaviest", "kinds", "near_you", "second_person", "capitals",
            "shouts", "punctuation", "disguised", "masked", "repeated", "length", "word_length")


def tokens(text: str) -> list[str]:
    return TOKENS.findall(text.lower())


def entries_of(token: str) -> list[str]:
    """What a token adds to the lexicon's candidates: itself and its beginnings, marked by a trailing dash."""
    return [token, *[token[:size] + "-" for size in (3, 4, 5, 6) if len(token) > size]]


class Lexicon(dict):
    """Weight of a token: its own or its beginnings' largest; looked up once per token and worker."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights
        self.plain = frozenset(INSULTS)

    def __missing__(self, token: str) -> float:
        if len(self) > REMEMBERED:
            self.clear()
        weights = self.weights
        found = max([weights.get(entry, 0.0) for entry in entries_of(token)])
        if token.translate(DISGUISE) in self.plain:
            found = max(found, STRONG)
        self[token] = found
        return found


def measure(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features of one text; an empty text has zeros."""
    found = tokens(text)
    if not found:
        return [0.0] * len(FEATURES)
    count, size = len(found), len(text)
    weights = [lexicon[token] for token in found]
    hits = [at for at, weight in enumerate(weights) if weight]
    you = [at for at, token in enumerate(found) if token in _YOU]
    near, following = 0, 0
    for at in hits:
        while following < len(you) and you[following] < at - 3:
            following += 1
        near += following < len(you) and you[following] <= at + 3
    strong = sum(1 for at in hits if weights[at] >= STRONG)
    insults = sum(1 for at in hits if found[at].translate(DISGUISE) in lexicon.plain)
    disguised = sum(1 for at in hits if not found[at].isalpha())
    letters = sum(map(len, found))
    per = 100.0 / count
    return [
        insults * per, strong * per, (len(hits) - strong) * per, sum(weights) * per, max(weights),
        float(len({found[at] for at in hits if weights[at] >= STRONG})), near * per, len(you) * per,
        len(CAPITALS.findall(text)) / size, text.count("!") / size, (size - letters) / size, disguised * per,
        len(MASKED.findall(text)) * per, len(REPEATED.findall(text)) * per, math.log1p(count), letters / count,
    ]


_YOU = frozenset(SECOND_PERSON)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Labelled rows that may be learnt from: text, toxic, part. A document with several labels is toxic if one
    of them says so. The chosen ids are at most twice ``sample``, so they are broadcast."""
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    mixed = F.xxhash64("doc_id")
    chosen = [usable.where(F.col("toxic") == kind).orderBy(mixed, "doc_id").limit(sample) for kind in (0, 1)]
    ids = kept(chosen[0].unionAll(chosen[1]), "toxicity-sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return kept(
        texts.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])
        .select("text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(PARTS)).cast("int").alias("part")),
        "toxicity-training",
    )


def _counting(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each part and class that an entry occurs in."""
    for batch in batches:
        counts: Counter[tuple[str, int]] = Counter()
        for text, toxic, part in zip(*[column.to_pylist() for column in batch.columns]):
            found: set[str] = set()
            for token in set(tokens(text)):
                found.update(entries_of(token))
            counts.update([(entry, part * 2 + toxic) for entry in found])
        yield pa.RecordBatch.from_arrays(
            [pa.array([entry for entry, _ in counts], pa.string()), pa.array([cell for _, cell in counts], pa.int32()),
             pa.array(list(counts.values()), pa.int64())],
            names=["entry", "cell", "times"],
        )


def lexicons(training: DataFrame) -> list[dict[str, float]]:
    """The lexicon without each part, and the one of all parts. The driver gets ``ENTRIES`` rows at most."""
    cells = range(2 * PARTS)
    sizes = {
        row["cell"]: row["count"]
        for row in training.select((F.col("part") * 2 + F.col("toxic")).alias("cell")).groupBy("cell").count().collect()
    }
    total = [sum(sizes.get(cell, 0) for cell in cells if cell % 2 == kind) for kind in (0, 1)]
    counted = training.mapInArrow(_counting, "entry string, cell int, times long").groupBy("entry").agg(
        *[F.sum(F.when(F.col("cell") == cell, F.col("times")).otherwise(0)).alias(f"c{cell}") for cell in cells]
    )
    toxic = sum((F.col(f"c{cell}") for cell in cells if cell % 2), F.lit(0))
    clean = sum((F.col(f"c{cell}") for cell in cells if cell % 2 == 0), F.lit(0))
    ratio = F.log((toxic + 0.5) / (total[1] + 1)) - F.log((clean + 0.5) / (total[0] + 1))
    best = (
        counted.where((toxic >= LEAST_DOCUMENTS) & (ratio >= LEAST_RATIO))
        .orderBy(F.desc(ratio * F.sqrt(toxic)), "entry").limit(ENTRIES).collect()
    )
    made = []
    for left_out in (*range(PARTS), None):
        kind_total = [
            sum(sizes.get(2 * part + kind, 0) for part in range(PARTS) if part != left_out) for kind in (0, 1)
        ]
        weights = {word: STRONG for word in INSULTS}
        for row in best:
            clean_n, toxic_n = [
                sum(row[f"c{2 * part + kind}"] for part in range(PARTS) if part != left_out) for kind in (0, 1)
            ]
            weight = math.log((toxic_n + 0.5) / (kind_total[1] + 1)) - math.log((clean_n + 0.5) / (kind_total[0] + 1))
            if toxic_n >= LEAST_DOCUMENTS - (left_out is not None) and weight >= LEAST_RATIO:
                weights[row["entry"]] = max(weight, weights.get(row["entry"], 0.0))
        made.append(weights)
    return made


def _texts(column: pa.Array) -> list[str]:
    """Texts of a column, or of the field ``text`` of whole rows."""
    texts = pc.struct_field(column, "text") if pa.types.is_struct(column.type) else column
    return [text or "" for text in texts.to_pylist()]


def _measuring(weights: list[dict[str, float]], column: int, part: int | None, keep: list[int]):
    """Adds features to each row: ``column`` holds the text, ``part`` names the lexicon (none: the last)."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Lexicon(one) for one in weights]
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                chosen = batch.column(part).to_pylist() if part is not None else [-1] * batch.num_rows
                measured = [measure(text, known[which]) for text, which in zip(_texts(batch.column(column)), chosen)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i) for i in keep], pa.array(measured, pa.list_(pa.float64()))],
                    names=[*[batch.schema.names[i] for i in keep], "measured"],
                )

    return each


class Scorer:
    """A trained model: ``scores(docs)`` gives doc_id and score of every row."""

    def __init__(self, training: DataFrame):
        self.weights = lexicons(training)
        measured = kept(
            training.mapInArrow(_measuring(self.weights, 0, 2, [1, 2]), "toxic int, part int, measured array<double>"),
            "toxicity-measured",
        ).select("part", F.col("toxic").cast("double").alias("label"), array_to_vector("measured").alias("features"))
        classes = {(row["part"] == 0, row["label"]) for row in measured.select("part", "label").distinct().collect()}
        self.trees = self.steps = None
        self.base = float(bool(classes) and all(label == 1.0 for _, label in classes))
        if {(False, 0.0), (False, 1.0)} <= classes:
            self.trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, seed=11).fit(measured.where("part <> 0"))
            if {(True, 0.0), (True, 1.0)} <= classes:
                raw = self.trees.transform(measured.where("part = 0")).select("label", _margin().alias("margin"))
                self.steps = IsotonicRegression(featuresCol="margin").fit(raw)

    def scored(self, rows: DataFrame, text: str, names: list[str]) -> DataFrame:
        """The columns ``names`` and ``score`` of rows; ``text`` is the column of the text, or of whole rows."""
        kinds = ", ".join(f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in names)
        arrow = rows.mapInArrow(
            _measuring(self.weights[-1:], rows.columns.index(text), None, [rows.columns.index(n) for n in names]),
            f"{kinds}, measured array<double>",
        )
        if self.trees is None:
            return arrow.select(*names, F.lit(self.base).alias("score"))
        shaped = arrow.select(*names, array_to_vector("measured").alias("features"))
        margins = self.trees.transform(shaped).select(*names, _margin().alias("margin"))
        if self.steps is None:
            return margins.withColumnRenamed("margin", "score")
        calibrated = self.steps.transform(margins)
        return calibrated.select(*names, F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0)).alias("score"))


def _margin() -> Column:
    return vector_to_array("probability")[1]


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, by its whole text alone.

    Null text counts as empty and is scored as such; a null doc_id is never held out nor learnt from; repeated
    rows are scored each; labels of unknown documents are passed over. Without labels of both classes the score
    is 1 if all labels are toxic, else 0. An empty table gives no rows; other columns are ignored.
    """
    scorer = Scorer(training_rows(docs, labels, sample))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return scorer.scored(rows, "text", ["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cut: float = CUT) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    scorer = Scorer(training_rows(docs, labels, sample))
    packed = docs.select(F.struct(*docs.columns).alias("kept"))
    return scorer.scored(packed, "kept", ["kept"]).where(F.col("score") < cut).select("kept.*")
