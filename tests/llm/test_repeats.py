import hashlib
import random
from collections import Counter

import pytest

from breathline.llm import repeats
from breathline.llm.gsaca import suffix_array


def brute(rows, length):
    texts = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    times = Counter(text[at:at + length] for _, text in texts for at in range(len(text) - length + 1))
    made = []
    for doc_id, text in texts:
        gone = bytearray(len(text))
        for at in range(len(text) - length + 1):
            if times[text[at:at + length]] > 1:
                gone[at:at + length] = b"\1" * length
        runs = len([run for run in bytes(gone).split(b"\0") if run])
        left = bytes(byte for byte, hit in zip(text, gone) if not hit)
        made.append((doc_id, len(text), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return sorted(made, key=str)


def found(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest())
                   for r in df.collect()), key=str)


@pytest.mark.parametrize("length, anchor, limit", [(200, 64, 4096), (200, 64, 1), (50, 16, 4096), (20, 8, 2)])
def test_removes_what_brute_force_removes(docs, corpus, length, anchor, limit):
    assert found(repeats.remove_repeats(docs, length, anchor, limit)) == brute(corpus, length)


@pytest.mark.parametrize("limit", [4096, 3])
def test_random_overlaps(spark, limit):
    chosen = random.Random(2)
    parts = ["".join(chosen.choice("abé ") for _ in range(chosen.randint(5, 60))) for _ in range(12)]
    rows = [(n, "".join(chosen.choice(parts) for _ in range(chosen.randint(0, 9)))) for n in range(80)]
    made = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(repeats.remove_repeats(made, 30, 8, limit)) == brute(rows, 30)


def test_long_texts_are_scanned_in_pieces(spark, monkeypatch, corpus):
    monkeypatch.setattr(repeats, "SLICE_BYTES", 700)
    monkeypatch.setattr(repeats, "LONGEST_RUN", 90)
    rows = [(doc_id, text) for doc_id, text in corpus if len(text or "") < 10_000]
    pieces = [(text or "").encode() for _, text in rows]
    owners, offsets, cut = repeats._pieces(pieces, 50)
    one = repeats.segments(cut, 50, 16)
    for number, text in enumerate(pieces):
        windows = set()
        for p, s, n in zip(one["piece"], one["start"], one["size"]):
            if owners[p] == number:
                windows.update(range(offsets[p] + s, offsets[p] + s + n - 49))
        assert windows == set(range(len(text) - 49))


def test_empty_table(no_docs):
    assert repeats.remove_repeats(no_docs).count() == 0


def test_suffix_array():
    chosen = random.Random(1)
    for _ in range(300):
        text = [chosen.randint(1, chosen.choice([1, 2, 5])) for _ in range(chosen.randint(0, 30))] + [0]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda at: text[at:])
