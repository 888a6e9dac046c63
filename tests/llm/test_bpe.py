import base64
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from breathline.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_round_trip(docs, corpus, library, listed):
    encoded = bpe.encode(docs, PATH, PATTERN)
    expected = []
    for doc_id, text in corpus:
        ids = library.encode_ordinary(text or "")
        expected.append((doc_id, len(ids), np.array(ids, dtype="<u4").tobytes()))
    assert [(d, n, bytes(i)) for d, n, i in listed(encoded)] == [
        (d, n, i) for d, n, i in sorted(((d, n, i) for d, n, i in expected), key=lambda r: str((r[0], r[1], bytearray(r[2]))))
    ]
    decoded = sorted((row["doc_id"] is None, row["doc_id"] or 0, bytes(row["decoded"])) for row in bpe.decode(encoded, PATH, PATTERN).collect())
    assert decoded == sorted((d is None, d or 0, (t or "").encode()) for d, t in corpus)


def test_empty_table(no_docs):
    encoded = bpe.encode(no_docs, PATH, PATTERN)
    assert encoded.count() == 0 and bpe.decode(encoded, PATH, PATTERN).count() == 0


def test_unknown_ids_add_nothing(spark):
    ids = np.array([10, 4_000_000, 11], dtype="<u4").tobytes()
    rows = spark.createDataFrame([(1, bytearray(ids)), (2, None)], "doc_id long, ids binary")
    found = {row["doc_id"]: bytes(row["decoded"]) for row in bpe.decode(rows, PATH, PATTERN).collect()}
    known = bpe.codec(PATH, PATTERN)
    by_rank = {rank: token for token, rank in known.ranks.items()}
    assert found == {1: by_rank[10] + by_rank[11], 2: b""}


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="ab \n'sl1é", max_size=60))
def test_any_text(text):
    known = bpe.codec(PATH, PATTERN)
    ids = known.ids([text])[0]
    library = _library(known)
    assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode_ordinary(text)
    assert known.decode([ids])[0] == text.encode()


def _library(known, made={}):  # noqa: B006  one encoder for all examples
    if not made:
        made["one"] = tiktoken.Encoding("any", pat_str=PATTERN, mergeable_ranks=known.ranks, special_tokens={})
    return made["one"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "ab", "the", "ing", "ion", "é", "中", "文", "中文", "th", "er", "x"]), min_size=30, max_size=200))
def test_long_matches(parts):
    """Matches of many buckets: letters without a space or mark between them."""
    known, text = bpe.codec(PATH, PATTERN), "".join(parts)
    assert np.frombuffer(known.ids([text])[0], dtype="<u4").tolist() == _library(known).encode_ordinary(text)


def test_time_of_a_long_varied_match():
    known, letters = bpe.codec(PATH, PATTERN), random.Random(1)
    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnop"):
        text = "".join(letters.choice(alphabet) for _ in range(100_000))
        began = time.perf_counter()
        ids = known.ids([text])[0]
        assert time.perf_counter() - began < 60
        assert np.frombuffer(ids, dtype="<u4").tolist() == _library(known).encode_ordinary(text)


@pytest.mark.parametrize("pattern", [r"\S+|\s+", r"[^ ]+ ?| ", r"(?s).{1,7}"])
def test_other_patterns(docs, corpus, listed, pattern):
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    other = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for doc_id, text in corpus:
        ids = other.encode_ordinary(text or "")
        expected.append((doc_id, len(ids), np.array(ids, dtype="<u4").tobytes(), (text or "").encode()))
    made = [(d, n, bytes(i), bytes(b)) for d, n, i, b in listed(bpe.round_trip(docs, PATH, pattern))]
    assert sorted(made, key=str) == sorted(expected, key=str)


def test_memory_of_words_is_bounded_and_changes_nothing(monkeypatch):
    known = bpe.Codec(PATH, PATTERN, True)
    texts = [" ".join(f"word{number} Other{number * 7}, more{number}!" for number in range(at, at + 40)) for at in range(0, 400, 30)]
    whole = [known.ids([text])[0] for text in texts]
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 20_000)
    short = bpe.Codec(PATH, PATTERN, True)
    for text, ids in zip(texts, whole):
        assert short.ids([text])[0] == ids and short.held <= 10_000
    assert sum(map(len, [*short.spaced, *short.plain])) < sum(map(len, [*known.spaced, *known.plain])) / 2
