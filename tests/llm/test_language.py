from itertools import product
from zlib import crc32

import numpy as np
import pytest
from llm_texts import prose
from pyspark.sql import functions as F

from breathline.llm import language

SF_DIR = "/root/testdata/sf0.01"


def by_paths(potentials, transitions):
    """Probabilities by the sum over all label sequences."""
    words, labels = potentials.shape
    found = np.zeros((words, labels))
    for path in product(range(labels), repeat=words):
        weight = np.prod([potentials[at, label] for at, label in enumerate(path)])
        weight *= np.prod([np.exp(transitions[one, two]) for one, two in zip(path, path[1:])])
        found[np.arange(words), path] += weight
    return found / found.sum(axis=1, keepdims=True)


def by_words(potentials, transitions):
    """Forward-backward word by word."""
    moves = np.exp(transitions)
    forward, backward = potentials.copy(), np.ones_like(potentials)
    for at in range(1, len(potentials)):
        forward[at] = potentials[at] * (forward[at - 1] @ moves)
        forward[at] /= forward[at].sum()
    for at in range(len(potentials) - 2, -1, -1):
        backward[at] = moves @ (potentials[at + 1] * backward[at + 1])
        backward[at] /= backward[at].sum()
    both = forward * backward
    return both / both.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("labels", [1, 2, 4])
def test_probabilities_of_many_sequences_at_once(labels, monkeypatch):
    rng = np.random.default_rng(labels)
    transitions = rng.normal(size=(labels, labels)) * 2
    for block in (1, 3, 32):
        monkeypatch.setattr(language, "BLOCK", block)
        monkeypatch.setattr(language, "BLOCKS_AT_ONCE", 5)
        lengths = np.array([1, 2, 3, 6, 31, 32, 33, 64, 65, 200, 1, 7])
        potentials = np.exp(rng.normal(size=(lengths.sum(), labels)) * 3)
        found = language.posteriors(potentials, transitions, lengths)
        begin = 0
        for length in lengths:
            part = potentials[begin:begin + length]
            expected = by_paths(part, transitions) if length < 7 else by_words(part, transitions)
            assert np.allclose(found[begin:begin + length], expected)
            begin += length
    assert language.posteriors(np.ones((0, labels)), transitions, np.array([], dtype=np.int64)).shape == (0, labels)


def test_long_texts_keep_their_scale():
    potentials = np.tile(np.array([[1e-60, 1.0]]), (100_000, 1))
    found = language.posteriors(potentials, np.zeros((2, 2)), np.array([100_000]))
    assert np.allclose(found, [0.0, 1.0])


def test_expected_counts_are_the_slopes():
    """What is learnt from: expected labels and transitions against the sums over all paths."""
    rng = np.random.default_rng(5)
    transitions, potentials = rng.normal(size=(3, 3)), np.exp(rng.normal(size=(9, 3)))
    lengths = np.array([5, 4])
    later = np.array([1, 2, 3, 4, 6, 7, 8])
    expected, pairs = language._expected(potentials, transitions, lengths, later)
    assert np.allclose(expected, np.concatenate([by_paths(potentials[:5], transitions), by_paths(potentials[5:], transitions)]))
    assert np.allclose(pairs.sum(), len(later))
    counted = np.zeros((3, 3))
    for part in (potentials[:5], potentials[5:]):
        total, seen = 0.0, np.zeros((3, 3))
        for path in product(range(3), repeat=len(part)):
            weight = np.prod(part[np.arange(len(part)), path]) * np.exp(sum(transitions[one, two] for one, two in zip(path, path[1:])))
            total += weight
            for one, two in zip(path, path[1:]):
                seen[one, two] += weight
        counted += seen / total
    assert np.allclose(pairs, counted)


def test_words():
    assert language.words_of("Don't 3½ ⅧÉté_x9y") == ["don", "t", "½", "ⅷété", "x", "y"]
    assert language.words_of("½ Ⅷ 12 --") == [] == language.words_of("")


def test_features():
    words = ["a", "abc", "nation", "a", "é" * 300, "\U00020000b", "nations"]
    owner, codes = language.features_of(words)
    sets = [set(codes[owner == at].tolist()) for at in range(len(words))]
    assert sets[0] == sets[3] and len({frozenset(one) for one in sets}) == 6
    for at, word in enumerate(words):
        alone = language.features_of([word])[1]
        assert sorted(alone) == sorted(codes[owner == at])
        longer = 4 if len(word) > 3 else 0
        assert len(alone) == 3 * (len(word) + 2) - 3 + longer + 1
    marked = "\x01abc\x02"
    grams = {ord(marked[at]) << 42 | (ord(marked[at + 1]) << 21 if width > 1 else 0) | (ord(marked[at + 2]) if width > 2 else 0)
             for width in (1, 2, 3) for at in range(len(marked) - width + 1)}
    assert {code for code in sets[1] if code >= 0} == grams
    assert len({code for code in sets[2] & sets[6] if code < 0}) == 2  # the same beginnings of three and four letters


@pytest.fixture(scope="module")
def learnt(spark):
    return language.train(spark.read.parquet(f"{SF_DIR}/documents.parquet"))


def test_held_out_accuracy(spark, learnt):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    made = language.predict_language(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    rows = made.collect()
    assert {row["held_out"] == (crc32(str(row["doc_id"]).encode()) % 4 == 2) for row in rows} == {True}
    assert sum(row["lang"] == row["lang_pred"] for row in rows) >= 0.98 * len(rows) and len(rows) > 200
    assert all(0 <= row["score"] <= 1 for row in rows)


def test_words_of_code_switched_texts(spark, learnt):
    """Parts of held-out documents of two languages after one another: each word has the language of its part."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where(language.held_out(F.col("doc_id")))
    by_lang = {}
    for row in docs.where("n_chars > 800").orderBy("doc_id").collect():
        by_lang.setdefault(row["lang"], []).append(" ".join(row["text"].split(" ")[20:70]))
    memory, right, total = language._Memory(learnt), 0, 0
    for one in by_lang:
        for two in by_lang:
            for left, right_part in list(zip(by_lang[one], by_lang[two]))[:8]:
                if one != two:
                    labels = language.label_words([left + " " + right_part], memory)[0].argmax(axis=1)
                    wanted = [one] * len(language.words_of(left)) + [two] * len(language.words_of(right_part))
                    right += sum(learnt.labels[label] == want for label, want in zip(labels, wanted))
                    total += len(wanted)
    assert total > 1500 and right >= 0.93 * total
    moves = learnt.transitions
    assert (np.diag(moves) > moves.mean(axis=1)).all()


def test_memory_is_bounded_and_changes_nothing(learnt, monkeypatch):
    texts = ["the river and the stones", "", "der Fluss und die Steine", "la rivière et les pierres"]
    whole = language.label_words(texts, language._Memory(learnt))
    monkeypatch.setattr(language, "REMEMBERED", 2)
    short = language._Memory(learnt)
    for text, expected in zip(texts, whole):
        assert np.allclose(language.label_words([text], short)[0], expected) and len(short) == 0


def test_odd_documents(spark, docs, corpus, no_docs, learnt):
    rows = language.identify(docs, learnt).collect()
    assert len(rows) == len(corpus)
    ids = sorted((row["doc_id"] is None, row["doc_id"] or 0) for row in rows)
    assert ids == sorted((doc_id is None, doc_id or 0) for doc_id, _ in corpus)
    lettered = {doc_id for doc_id, text in corpus if any(map(str.isalpha, text or ""))}
    for row in rows:
        assert (row["lang_pred"] == "und") == (row["doc_id"] not in lettered) and 0 <= row["score"] <= 1
    assert language.identify(no_docs, learnt).count() == 0 == language.predict_language(no_docs).count()
    made = language.predict_language(docs)
    assert made.columns == ["doc_id", "held_out", "lang_pred", "score"]
    known = {row["lang_pred"] for row in made.collect()}
    assert known <= {"en", "de", "und"} and "und" in known


def test_without_languages_or_with_one(spark):
    rows = [(number, prose(number, 30)) for number in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = language.predict_language(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(row["lang_pred"], row["score"]) for row in none} == {("und", 0.0)}
    one = language.predict_language(docs.withColumn("lang", F.lit("xx"))).collect()
    assert {(row["lang_pred"], row["score"]) for row in one} == {("xx", 1.0)}


def test_sample_is_bounded_and_leaves_out_held_out_rows(spark):
    rows = [(number % 90, prose(number, 5), "en" if number % 3 else "de") for number in range(400)] + [(None, "a b", "en"), (7, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    chosen = language.training_rows(docs, sample=10).collect()
    assert len(chosen) == 20 == len({row["doc_id"] for row in chosen})
    assert not any(crc32(str(row["doc_id"]).encode()) % 4 == 2 for row in chosen)
