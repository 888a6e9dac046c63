import base64
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from breathline.llm import secret_scan

from llm_texts import prose


@pytest.fixture(scope="module")
def planted(spark):
    rows, truth = [], {}
    for doc_id in range(60):
        hexed = hashlib.sha1(str(doc_id).encode()).hexdigest()
        line = [f'token = "{hexed}"', f"commit {hexed}", "password: changeme12example", f'TOKEN = "{hexed.upper()}"', "nothing"][doc_id % 5]
        rows.append((doc_id, f"{prose(doc_id, 20)} {line} {prose(doc_id + 500, 20)} ünï {line}", "src0", 0))
        truth[doc_id] = doc_id % 5 in (0, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    return docs.withColumns({n: F.lit("x") for n in ("found", "start", "score", "before", "path", "_secrets")}).repartition(3), truth


def test_true_findings_stay_and_false_ones_go(planted):
    docs, truth = planted
    texts = {row["doc_id"]: row["text"] for row in docs.collect()}
    rows = secret_scan.scan_secrets(docs, secret_scan.labelled_findings(docs)).collect()
    confirmed = {row["doc_id"] for row in rows if row["is_secret"]}
    assert confirmed == {doc_id for doc_id, true in truth.items() if true}
    assert {row["doc_id"] for row in rows} >= {d for d in truth if d % 5 in (0, 1, 2, 3)}
    for row in rows:
        assert texts[row["doc_id"]][row["start"]:row["start"] + row["length"]] == row["found"]


def test_findings_are_all_matches(docs, corpus):
    pattern = re.compile(secret_scan.CANDIDATE)
    found = sorted((str(r["doc_id"]), r["start"], r["found"]) for r in secret_scan.findings(docs).collect())
    assert found == sorted((str(d), m.start(), m.group()) for d, t in corpus for m in pattern.finditer(t or ""))


def test_keys_are_whole_whatever_their_length(planted):
    docs, _ = planted
    key = lambda length: "".join(hashlib.sha1(f"{length}:{at}".encode()).hexdigest() for at in range(length // 40 + 1))[:length]
    mixed = "ghp_" + re.sub("[+/=]", "q", base64.b64encode(key(450).encode().translate(bytes(range(256))[::-1])).decode())
    late = "aBcDeFgHiJ" * 5 + key(30).replace("e", "7")
    texts = [f"{prose(1, 9)} {before}{found}{after} {prose(2, 9)}" for before, found, after in (
        ("", f'aws_session_token="{key(600)}', '"'), ("Authorization: Bearer ", key(600), ""), ("", mixed, ""),
        ("", f"secret: {key(100_000)}", ""), ("Authorization: Bearer ", key(100_000), ""), ("Authorization: Bearer ", late, ""),
    )]
    long = docs.sparkSession.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labelled = secret_scan.labelled_findings(docs)
    keys = [key(600), key(600), mixed, key(100_000), key(100_000), late]
    rows = secret_scan.scan_secrets(long, labelled).collect()
    assert sorted((r["doc_id"], r["found"].removeprefix('token="').removeprefix("secret: "), r["is_secret"]) for r in rows) == [
        (at, one, 1) for at, one in enumerate(keys)
    ]
    left = {r["doc_id"]: r["text"] for r in secret_scan.redact(long, labelled).collect()}
    assert all("[secret]" in text and len(text) < 250 for text in left.values()) and len(left) == len(texts)


def test_without_labels_every_candidate_stays(planted):
    docs, _ = planted
    none = secret_scan.labelled_findings(docs).limit(0)
    assert {row["is_secret"] for row in secret_scan.scan_secrets(docs, none).collect()} == {1}


def test_redaction(planted):
    docs, truth = planted
    changed = secret_scan.redact(docs, secret_scan.labelled_findings(docs))
    assert changed.columns == docs.columns
    for row in changed.collect():
        assert ("[secret]" in row["text"]) == truth[row["doc_id"]]
        assert not re.search('(?i)token = "[0-9a-f]{40}', row["text"])
        assert row["n_chars"] == (len(row["text"]) if truth[row["doc_id"]] else 0)


def test_rows_without_doc_id_are_redacted(planted):
    docs, truth = planted
    nameless = docs.withColumn("doc_id", F.when(F.col("doc_id") >= 20, F.col("doc_id")))
    labelled = secret_scan.labelled_findings(docs)
    named = {row["text"]: row["doc_id"] for row in docs.collect()}
    texts = sorted(row["text"] for row in secret_scan.redact(docs, labelled).collect())
    changed = secret_scan.redact(nameless, labelled).collect()
    assert sorted(row["text"] for row in changed) == texts
    for row in changed:
        if row["doc_id"] is None:
            assert "[secret]" in row["text"] or not truth[named[row["text"]]]
            assert row["n_chars"] == (len(row["text"]) if "[secret]" in row["text"] else 0)
    assert sum(row["doc_id"] is None and "[secret]" in row["text"] for row in changed) == sum(truth[d] for d in range(20))


def test_odd_documents(docs, no_docs, corpus):
    labelled = secret_scan.labelled_findings(docs)
    assert secret_scan.scan_secrets(no_docs, labelled).count() == 0
    assert secret_scan.redact(no_docs, labelled).count() == 0
    assert secret_scan.redact(docs, labelled).count() == len(corpus)
    assert secret_scan.labelled_findings(no_docs).count() == 0


def test_path_and_following_words_decide(planted):
    """A password of no known form counts in a document's own path and not in a path of tests; a digest counts by the
    words that follow it; a key of known form counts anywhere."""
    docs, _ = planted
    password, digest = "password: Zk4tQ9vBx2Lw7R", hashlib.sha1(b"x").hexdigest()
    known = "ghp_" + hashlib.sha256(b"y").hexdigest()[:36]
    cases = [
        (password, "src0", 1), (password, "tests/fixtures/src0", 0), (known, "src0", 1), (known, "tests/fixtures/src0", 1),
        (f'"{digest}" api key', "src0", 1), (f'"{digest}" checksum', "src0", 0),
    ]
    rows = [(n, f"{prose(n, 9)} {text} {prose(n + 50, 9)}", path) for n, (text, path, _) in enumerate(cases)]
    asked = docs.sparkSession.createDataFrame(rows, "doc_id long, text string, source string")
    labelled = secret_scan.labelled_findings(docs)
    forest = secret_scan.train(labelled)
    weight = dict(zip(secret_scan.FEATURES, forest.featureImportances.toArray()))
    assert all(weight[name] > 0 for name in ("test_path", "keyword_after", "harmless_after"))
    found = {r["doc_id"]: r["is_secret"] for r in secret_scan.scan_secrets(asked, labelled).collect()}
    assert found == {n: wanted for n, (_, _, wanted) in enumerate(cases)}


def test_held_out_findings(planted):
    """Learnt from half of the documents, asked about the findings of the others."""
    docs, _ = planted
    learnt = secret_scan.labelled_findings(docs.where("doc_id % 2 = 0"))
    held = secret_scan.labelled_findings(docs.where("doc_id % 2 = 1"))
    rows = secret_scan._scored(held, learnt).select("is_secret", "score").collect()
    hits = sum(r["score"] >= secret_scan.CUT and r["is_secret"] == 1 for r in rows)
    assert hits / sum(r["is_secret"] for r in rows) >= 0.95
    assert hits / sum(r["score"] >= secret_scan.CUT for r in rows) >= 0.95


def test_many_candidates_of_one_text(planted):
    """Offsets are running sums: eight thousand candidates, each where it stands."""
    docs, _ = planted
    text = " ".join(f"ünï token=abc{n:08d}" for n in range(8000))
    rows = secret_scan.findings(docs.sparkSession.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert len(rows) == 8000 and all(text[r["start"]:].startswith(r["found"]) for r in rows)
    assert [r["number"] for r in sorted(rows, key=lambda r: r["start"])] == list(range(8000))


def test_repeated_ids_are_one_sample(planted):
    docs, _ = planted
    twice = docs.unionByName(docs.withColumn("text", F.concat("text", F.lit(" later"))))
    assert secret_scan.labelled_findings(twice, sample=7).count() == secret_scan.labelled_findings(docs, sample=7).count()
