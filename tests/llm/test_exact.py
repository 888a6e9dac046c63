import hashlib
import re

from pyspark.sql import functions as F

from breathline.llm import exact


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(corpus):
    groups = {}
    for doc_id, text in corpus:
        groups.setdefault(norm(text), []).append(doc_id)
    rows = []
    for text, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = min(named) if named else None
        first = True
        for doc_id in ids:
            stays = doc_id == keep and first
            first = first and not stays
            rows.append((doc_id, keep, len(ids), stays, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(rows, key=str)


def test_groups(docs, corpus, listed):
    assert listed(exact.exact_groups(docs)) == expected(corpus)


def test_groups_when_identifiers_collide(docs, corpus, listed):
    weak = lambda chunk: F.encode(F.pmod(F.xxhash64(chunk), F.lit(2)).cast("string"), "UTF-8")
    assert listed(exact.exact_groups(docs, weak)) == expected(corpus)


def test_chunks_of_equal_passages_are_shared(spark):
    text = " ".join(f"w{at * at % 9973}" for at in range(4000))
    row = spark.createDataFrame([(norm(text),), (norm("changed " + text),)], "text string").select(
        exact.chunks(F.col("text")).alias("chunks")
    ).collect()
    one, two = row[0]["chunks"], row[1]["chunks"]
    assert len(one) > 20 and len(set(one) - set(two)) <= 1
    assert " ".join(c.removesuffix("\n") for c in one) == norm(text)


def test_drop_copies_follows_kept_without_doc_id(docs, listed):
    more = docs.unionByName(docs.where("doc_id is null")).unionByName(docs.where("doc_id = 0"))
    stay = exact.exact_groups(more).where("kept").select("doc_id", "text_sha256")
    made = exact.drop_copies(more)
    assert made.columns == docs.columns
    sha = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)
    assert listed(made.select("doc_id", sha.alias("text_sha256"))) == listed(stay)


def test_a_space_after_a_cut_is_part_of_the_text(spark, listed):
    marked = spark.range(200).select(F.concat(F.lit("word"), "id").alias("w")).where(
        F.pmod(F.xxhash64("w"), F.lit(exact.MASK)) == 0).first()["w"]
    texts = [f"a b {marked}", f"a b {marked}\n", f"a b {marked} ", marked, f"{marked} ", f" {marked}", f"{marked} {marked}",
             f"{marked} {marked} ", "x" * exact.LONGEST + f" {marked}", "x" * exact.LONGEST + f" {marked}\n", "", " "]
    corpus = list(enumerate(texts))
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    assert listed(exact.exact_groups(docs)) == expected(corpus)
    assert {r["doc_id"] for r in exact.drop_copies(docs).collect()} == set(range(len(texts))) - {2}
    for row in docs.select("text", exact.chunks(F.regexp_replace("text", "\n", " ")).alias("chunks")).collect():
        cut = "".join(c.replace("\n", "\n ") if at + 1 < len(row["chunks"]) else c for at, c in enumerate(row["chunks"]))
        assert cut.replace("\n", "") == norm(row["text"])


def test_empty_table(no_docs):
    assert exact.exact_groups(no_docs).count() == 0 and exact.drop_copies(no_docs).count() == 0


def test_drop_copies_keeps_one_row_of_each_text(docs, corpus):
    kept = exact.drop_copies(docs.where("doc_id is not null"))
    assert kept.columns == docs.columns
    rows = kept.collect()
    named = [(d, t) for d, t in corpus if d is not None]
    assert sorted(norm(r["text"]) for r in rows) == sorted({norm(t) for _, t in named})
    assert {r["doc_id"] for r in rows} == {min(d for d, t in named if norm(t) == x) for x in {norm(t) for _, t in named}}
