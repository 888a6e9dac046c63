import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest
from hypothesis import given, settings, strategies as st
from llm_texts import prose

from breathline.llm import resample

LAST = (1 << 63) - 1


def features(text, grams):
    lowered = re.sub("[A-Z]", lambda found: found[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [" ".join(words[at:at + size]) for size in range(1, grams + 1) for at in range(len(words) - size + 1)]


def expected(corpus, target, grams=1, buckets=10_000, least=20, percent=10, seed=2024):
    def bucket(feature):
        return crc32(feature.encode()) % buckets

    here = Counter(bucket(one) for _, text in corpus for one in features(text, grams)[1])
    there = Counter(bucket(one) for text in target for one in features(text, grams)[1])
    s_all, t_all = sum(here.values()), sum(there.values())
    rows = []
    for doc_id, text in corpus:
        words, found = features(text, grams)
        gains = [
            math.floor(1000 * math.log((there[b] + 1) * (s_all + buckets) / ((here[b] + 1) * (t_all + buckets))))
            for b in map(bucket, found)
        ]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((len(words) >= least, doc_id, len(found), weight, score))
    able = sorted((row for row in rows if row[0]), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2], r[3]))
    drawn = len(able) * percent // 100
    made = [(*row[1:], place + 1 if place < drawn else None) for place, row in enumerate(able)]
    return sorted([*made, *((*row[1:], None) for row in rows if not row[0])], key=str)


TARGET = [prose(90, 200), prose(91, 50).upper(), None, "", "green canal GREEN"]


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(at, text) for at, text in enumerate(TARGET)], "score long, text string")


@pytest.mark.parametrize("grams, buckets, percent, rows_sorted", [
    (1, 10_000, 10, 20_000), (2, 500, 50, 2), (3, 7, 100, 1), (1, 10_000, 0, 20_000), (1, 100, 33, 3),
])
def test_against_brute_force(docs, corpus, target, listed, grams, buckets, percent, rows_sorted):
    made = resample.importance_sample(docs, target, grams, buckets, percent=percent, sorted_rows=rows_sorted)
    assert made.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert listed(made) == expected(corpus, TARGET, grams, buckets, percent=percent)


def test_many_documents_and_equal_scores(spark, listed, target):
    """A third of the rows are copies of one row; ids lie at both ends of the long range."""
    corpus = [(number, prose(number, 15 + number % 12)) for number in range(300)]
    corpus += [(5, corpus[5][1])] * 150 + [(LAST, prose(1, 25)), (-LAST - 1, prose(1, 25)), (None, prose(1, 25)), (None, prose(2, 30))]
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(4)
    made = resample.importance_sample(docs, target, percent=40, sorted_rows=4)
    assert listed(made) == expected(corpus, TARGET, percent=40)


@given(st.lists(st.sampled_from([-LAST - 1, -5, -4, 0, 1, 2, 3, 1 << 62, LAST - 1, LAST]) | st.integers(-50, 50), min_size=1, max_size=60), st.data())
@settings(max_examples=12, deadline=None)
def test_kth_largest(spark, values, data):
    k = data.draw(st.integers(1, len(values)))
    rows = spark.createDataFrame([(value,) for value in values], "v long")
    found, above = resample.kth_largest(rows, "v", k, sorted_rows=data.draw(st.sampled_from([1, 5])), margin=0.01)
    ordered = sorted(values, reverse=True)
    assert found == ordered[k - 1] and above == sum(value > found for value in values)


def test_bracket_that_misses_is_widened(spark, monkeypatch):
    rows = spark.range(1000).withColumnRenamed("id", "v")
    asked, real = [], resample._bracket

    def far_off(spark, sketch, share, reach, lowest, highest):
        asked.append(reach)
        return (0, 3) if len(asked) == 1 else real(spark, sketch, share, reach, lowest, highest)

    monkeypatch.setattr(resample, "_bracket", far_off)
    assert resample.kth_largest(rows, "v", 100, sorted_rows=50) == (900, 99) and len(asked) >= 2


def test_empty_tables(spark, docs, corpus, no_docs, target, listed):
    assert resample.importance_sample(no_docs, target).count() == 0
    none = spark.createDataFrame([], "text string")
    assert listed(resample.importance_sample(docs, none, percent=30)) == expected(corpus, [], percent=30)
