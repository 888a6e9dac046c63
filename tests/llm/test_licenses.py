import re
from collections import Counter

from breathline.llm import licenses

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, templates, threshold, width, stride):
    made = []
    for doc_id, text in rows:
        words = WORDS.findall((text or "").translate(LOWER))
        hits, base, labels, best = [], set(), set(), 0.0
        for phrase, label in licenses.PHRASES.items():
            parts = phrase.split()
            for at in range(len(words)):
                if words[at:at + len(parts)] == parts:
                    hits.append(at)
                    base.add(label)
        for at in range(0, len(words), stride):
            block = set(words[at:at + width])
            for label, notice in templates.items():
                wanted = set(notice.split())
                if len(block & wanted) >= threshold * len(wanted) - 1e-9:
                    labels.add(label)
                    best = max(best, len(block & wanted) / len(wanted))
        made.append((doc_id, len(words), len(hits), min(hits, default=None), max(hits, default=None),
                     ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if hits else best))
    return sorted(made, key=str)


def test_every_block_and_phrase(docs, corpus, listed):
    found = licenses.scan_licenses(docs)
    assert listed(found) == brute(corpus, licenses.TEMPLATES, licenses.THRESHOLD, 2 * licenses.STRIDE, licenses.STRIDE)


def test_notices_are_found(docs, listed):
    labels = dict(listed(licenses.scan_licenses(docs).where("labels <> ''"), "doc_id", "labels"))
    assert set(labels.values()) == {"cc-by,reserved", "gpl,gpl-3.0", "mit", "cc-by,cc-by-nc-4.0", "gpl"}


def test_any_templates_and_threshold(docs, corpus, listed):
    templates = {"a": "the river stone", "b": "old canal where children sang about winter", "c": "seven"}
    for threshold in (0.4, 0.7, 1.0):
        found = licenses.scan_licenses(docs, templates, threshold=threshold, stride=5)
        assert listed(found) == brute(corpus, templates, threshold, 14, 7)  # the longest template has seven words


def test_global_order_counts_all_texts(docs, corpus):
    order = licenses.global_order(docs, {"the", "river", "absent"})
    times = Counter(word for _, text in corpus for word in WORDS.findall((text or "").translate(LOWER)))
    assert sorted(order, key=order.get) == sorted(order, key=lambda word: (times[word], word))


def test_empty_table(no_docs):
    assert licenses.scan_licenses(no_docs).count() == 0


def test_templates_of_any_length(spark):
    """Templates of 40, 90 and 300 words are found wherever they stand, with a few words of them changed."""
    templates = {f"t{size}": " ".join(f"w{size}x{number}" for number in range(size)) for size in (40, 90, 300)}
    rows, expected = [], {}
    for size in (40, 90, 300):
        for shift in (0, 1, 23, 59, 250):
            words = templates[f"t{size}"].split()
            words[size // 2] = "other"
            expected[len(rows)] = f"t{size}"
            rows.append((len(rows), " ".join(["before"] * shift + words + ["after"] * 70)))
        rows.append((len(rows), " ".join(templates[f"t{size}"].split()[: size // 2])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {row["doc_id"]: row["labels"] for row in licenses.scan_licenses(docs, templates).where("labels <> ''").collect()}
    assert found == expected
