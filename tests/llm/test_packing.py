import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from breathline.llm import packing

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
LIBRARY = Tokenizer.from_file(PATH)
TOKENS = packing.Tokens(PATH, PATTERN)


def ids_of(text):
    return np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, packing.END_ID], dtype="<u4").tobytes()


def test_every_id_lies_in_one_piece(docs, corpus):
    rows = packing.pack(docs, PATH, PATTERN, capacity=512, piece=128, block=16).collect()
    expected = {}
    for doc_id, text in corpus:
        expected.setdefault(doc_id, []).append(ids_of(text))
    by_doc = {}
    for row in rows:
        by_doc.setdefault(row["doc_id"], []).append(row)
    assert by_doc.keys() == expected.keys()
    for doc_id, texts in expected.items():
        whole = sorted((r["start"], bytes(r["ids"])) for r in by_doc[doc_id])
        assert sum(len(part) for _, part in whole) == sum(map(len, texts))
        for start, part in whole:
            assert any(text[4 * start:4 * start + len(part)] == part for text in texts)
        assert {r["doc_tokens"] for r in by_doc[doc_id]} == {len(text) // 4 for text in texts}
    windows = {}
    for row in rows:
        assert row["length"] * 4 == len(row["ids"]) > 0
        windows.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 512


def test_digest(docs):
    packed = packing.pack(docs, PATH, PATTERN)
    crcs = sorted(zlib.crc32(bytes(row["ids"])) for row in packed.collect())
    assert sorted(row["ids_crc32"] for row in packing.digest(packed).collect()) == crcs


def test_empty_table(no_docs):
    assert packing.pack(no_docs, PATH, PATTERN).count() == 0


def test_special_tokens_are_those_of_the_library():
    for text in ("<|endoftext|>", "a <|endoftext|> b", "<| x |>"):
        assert TOKENS.encode(text) == np.array(LIBRARY.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=120) | st.text(alphabet="aAbt \n\t'sl1é.ñ", max_size=80))
def test_ids_of_any_text(text):
    assert TOKENS.encode(text) == np.array(LIBRARY.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_windows_keep_the_capacity_and_little_is_left(sizes):
    window = packing.dealt(np.array(sizes, dtype=np.int64), 100)
    loads = np.bincount(window, weights=sizes) if sizes else np.zeros(1)
    assert len(window) == len(sizes) and loads.max() <= 100


def test_differencing_is_near_equal():
    sizes = np.random.default_rng(0).integers(1, 512, size=1024)
    loads = np.bincount(packing.differenced(sizes, 128), weights=sizes, minlength=128)
    assert loads.sum() == sizes.sum() and loads.max() - loads.min() < 0.02 * loads.mean()
    sizes = np.array([8, 7, 6, 5, 4])  # the textbook case: differencing ends two apart
    assert sorted(np.bincount(packing.differenced(sizes, 2), weights=sizes)) == [14, 16]
