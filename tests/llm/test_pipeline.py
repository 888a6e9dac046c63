import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from llm_texts import edited, prose

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables as the queries read them: clean, toxic, copied, nearly copied and leaking documents."""
    rows, labels = [], []
    for doc_id in range(240):
        text = prose(3000 + doc_id, 80)
        if doc_id % 4 == 0:
            text = " ".join(f"{word} you idiot moron" if at % 10 == 0 else word for at, word in enumerate(text.split(" ")))
        if doc_id % 10 == 1:
            text += f' token = "{doc_id:040x}"'.replace("0000000", "3fa9c1b")
        rows.append((doc_id, text))
        labels.append((doc_id, 1, int(doc_id % 4 == 0)))
    copies = [(1000 + d, t.replace(" ", "\n")) for d, t in rows if d % 6 == 5]
    near = [(2000 + d, edited(t, 75)) for d, t in rows if d % 6 == 3 and d % 4]
    made = [*rows, *copies, *near, (3000, None), (3001, "")]
    top = str(tmp_path_factory.mktemp("tables"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(d, t, "en", "src", len(t or "")) for d, t in made], schema).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    return top, rows, copies, near


def test_stages_take_effect(spark, folder, tmp_path):
    top, rows, copies, near = folder
    docs = spark.read.parquet(f"{top}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, top)
        made.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs
        if name != "packing":
            assert docs.columns == COLUMNS
    ids = {name: {row["doc_id"] for row in made.select("doc_id").collect()} for name, made in seen.items()}
    toxic = {d for d, _ in rows if d % 4 == 0}
    assert len(ids["toxicity"] & toxic) <= 3 and {d for d, _ in rows if d % 4} <= ids["toxicity"]
    assert not ids["exact_dedup"] & {d for d, _ in copies if d - 1000 in ids["toxicity"]}
    assert ids["toxicity"] - ids["exact_dedup"] <= {d for d, _ in copies} | {3001}
    assert ids["exact_dedup"] - ids["near_dedup"] == {d for d, _ in near} & ids["exact_dedup"]
    assert ids["near_dedup"] == ids["secret_scan"] == ids["packing"]
    texts = {row["doc_id"]: row["text"] for row in seen["secret_scan"].collect()}
    leaking = {d for d, _ in rows if d % 10 == 1} & set(texts)
    assert all("[secret]" in texts[d] for d in leaking) and not any(re.search('token = "', t or "") for t in texts.values())
    assert sum(t is not None and "[secret]" in t for t in texts.values()) == len(leaking)


def test_run_gives_the_last_stage(spark, folder):
    top, rows, copies, near = folder
    made = corpus_pipeline.run(spark, top)
    sums = made.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m")).collect()
    assert sums and all(row["n"] == row["m"] <= 2048 for row in sums)


def test_no_documents(spark, folder, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder[0])
        assert docs.count() == 0
