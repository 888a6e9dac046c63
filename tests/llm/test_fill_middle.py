import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from breathline.llm import fill_middle

PATTERNS = {"lines": r"[^\n]*\n|[^\n]+", "sentences": r"[^.!?\n]*[.!?\n]|[^.!?\n]+", "words": r"\S*\s|\S+"}


def expected(doc_id, text, unit, seed=7, percent=100, spm=50):
    text = text or ""
    units = re.findall(PATTERNS[unit], text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    one, two, third, fourth = (int(digest[at:at + 8], 16) for at in (0, 8, 16, 24))
    low, high = sorted([one % (len(units) + 1), two % (len(units) + 1)])
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or third % 100 >= percent:
        return doc_id, len(units), "plain", None, None, text
    if fourth % 100 < spm:
        return doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@given(st.lists(st.integers(0, 3), max_size=300))
@settings(max_examples=60, deadline=None)
def test_ranks(symbols):
    matrix = fill_middle.WaveletMatrix(np.array(symbols, dtype=np.uint8))
    places = np.arange(len(symbols) + 1)
    for symbol in range(4):
        counted = np.concatenate([[0], np.cumsum(np.array(symbols, dtype=np.int64) == symbol)])
        assert matrix.rank(symbol, places).tolist() == counted.tolist()


EXTRA = ["\n", "\n\n\n", "a\n", "\na", "one\ntwo\nthree", "line\r\nline", "with <P> inside\nb", "<S>", "x<M\n>y", "<", "<P", "P>\nS>",
         "a b\x85c\x0bd\n", "\U0001F642\n\U0001F642\U0001F642\nz", "no end." * 50, "\n" * 5000, "q" * 70_000 + "\n" + "r" * 70_000]


@pytest.mark.parametrize("unit", ["lines", "sentences", "words"])
def test_against_regular_expressions(spark, docs, corpus, unit):
    more = [(1000 + at, text) for at, text in enumerate(EXTRA)] + [(-1, EXTRA[4]), (None, None), (-(1 << 63), EXTRA[4])]
    rows = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    made = [tuple(row) for row in fill_middle.fill_in_middle(rows, unit=unit).collect()]
    wanted = [expected(doc_id, text, unit) for doc_id, text in [*corpus, *more]]
    assert sorted(made, key=str) == sorted(wanted, key=str)


@pytest.mark.parametrize("percent, spm", [(0, 50), (60, 0), (60, 100)])
def test_rates(docs, corpus, percent, spm):
    made = fill_middle.fill_in_middle(docs, seed=3, percent=percent, spm_percent=spm).collect()
    wanted = [expected(doc_id, text, "lines", 3, percent, spm) for doc_id, text in corpus]
    assert sorted(map(tuple, made), key=str) == sorted(wanted, key=str)


def test_restored(spark, docs):
    more = spark.createDataFrame([(1000 + at, text) for at, text in enumerate(EXTRA)], "doc_id long, text string")
    rows = docs.unionByName(more, allowMissingColumns=True)
    made = fill_middle.fill_in_middle(rows)
    back = made.select("doc_id", fill_middle.restored(F.col("form"), F.col("output")).alias("back"))
    wanted = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("back"))
    assert back.exceptAll(wanted).isEmpty() and wanted.exceptAll(back).isEmpty()
    empty = spark.createDataFrame([(None, "x"), ("psm", None)], "form string, output string")
    assert [row[0] for row in empty.select(fill_middle.restored(F.col("form"), F.col("output"))).collect()] == [None, None]


def test_many_slices(docs, corpus, monkeypatch):
    monkeypatch.setattr(fill_middle, "SLICE_BYTES", 40)
    made = [tuple(row) for row in fill_middle.fill_in_middle(docs).collect()]
    assert sorted(made, key=str) == sorted((expected(doc_id, text, "lines") for doc_id, text in corpus), key=str)


def test_empty_table(no_docs):
    assert fill_middle.fill_in_middle(no_docs).count() == 0


@pytest.mark.parametrize("markers", [("", "<S>", "<M>"), ("<P>", "<P><", "<M>"), ("aba", "<S>", "<M>"), ("<P>", "><", "<M>"), ("x", "axb", "c")])
def test_markers_that_could_hide_each_other(docs, markers):
    with pytest.raises(ValueError, match="overlap"):
        fill_middle.fill_in_middle(docs, markers=markers)
