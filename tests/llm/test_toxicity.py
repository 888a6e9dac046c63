import zlib

import pytest
from pyspark.sql import functions as F

from breathline.llm import toxicity

from llm_texts import prose


@pytest.fixture(scope="module")
def labelled(spark):
    """Clean and toxic prose; some toxic documents have words of a language that only the labels tell."""
    rows, labels = [], []
    for doc_id in range(360):
        text, toxic = prose(1000 + doc_id, 60), int(doc_id % 3 == 0)
        if toxic:
            insult = "you IDIOT and m0ron" if doc_id % 2 else f"zorgat{doc_id % 7} zorgen du"
            text = " ".join(f"{word} {insult}" if at % 12 == 0 else word for at, word in enumerate(text.split(" ")))
        rows.append((doc_id, text))
        if doc_id % 10 < 8:
            labels.append((doc_id, 0, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("x") for n in ("score", "features", "label", "margin")})
    return docs.repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_scored_right(labelled):
    docs, labels = labelled
    rows = toxicity.score_documents(docs, labels).collect()
    assert len(rows) == 360 and all(0 <= row["score"] <= 1 for row in rows)
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1) for row in rows)
    assert all(row["predicted"] == int(row["score"] >= 0.7) for row in rows)
    unseen = [row for row in rows if row["held_out"]]
    assert sum(row["predicted"] == int(row["doc_id"] % 3 == 0) for row in unseen) >= 0.95 * len(unseen)


def test_held_out_labels_change_nothing(labelled, listed):
    docs, labels = labelled
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert listed(toxicity.score_documents(docs, labels)) == listed(toxicity.score_documents(docs, turned))


def test_odd_documents(docs, no_docs, labelled, spark, corpus):
    _, labels = labelled
    odd = labels.unionAll(spark.createDataFrame([(None, 0, 1), (3, None, None), (9, 0, 7), (10**9, 0, 1)], labels.schema))
    assert toxicity.score_documents(docs, odd).count() == len(corpus)
    assert toxicity.score_documents(no_docs, labels).count() == 0
    for one, score in ((labels.limit(0), 0.0), (labels.where("toxic = 0"), 0.0)):
        assert {row["score"] for row in toxicity.score_documents(docs, one).collect()} == {score}


def test_drop_toxic_keeps_clean_rows_whole(labelled):
    docs, labels = labelled
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = {row["doc_id"] for row in kept.collect()}
    assert len(ids & {i for i in range(360) if i % 3}) >= 235 and len(ids & {i for i in range(360) if not i % 3}) <= 8


def test_measures():
    lexicon = toxicity.Lexicon({"idiot": 5.0, "zorg-": 4.5})
    names = dict(zip(toxicity.FEATURES, toxicity.measure("You 1d1ot! Zorgat here, YOU f**l", lexicon)))
    assert names["insults"] > 0 and names["strong"] > names["insults"] and names["near_you"] > 0 and names["masked"] > 0
    assert names["disguised"] > 0 and names["capitals"] > 0
    assert toxicity.measure("", lexicon) == [0.0] * len(toxicity.FEATURES)
