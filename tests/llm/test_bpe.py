"""op3 and op7 against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cabflow.llm.bpe_codec import Codec, decode, encode, round_trip_digests
from cabflow.llm.token_counts import TokenCounter, merged_length, token_counts
from cabflow.llm.vocab import Vocab
from tests.llm.helpers import clashing, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)
with open(PATH, "rb") as f:
    VOCAB = Vocab(f.read())
CODEC, COUNTER = Codec(VOCAB), TokenCounter(VOCAB)

ODD = ["", " ", "\n\n  x", "don't 'start ''s  'll", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>",
       "aaaa" * 5000, " " * 500 + "x", "\x1c\x1d x\x85y　z", "日本語テキスト 한국어 😀😀👩‍👩‍👧", "é" * 3000,
       "​  x", "!!!!" * 999, "İstanbul ǅ ²³¼ Ⅷ", "x\r\n\ty", "�\x00a", "a" * 200_000]


def lib_ids(text):
    return LIB.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    ids = lib_ids(text)
    assert CODEC.encode(text).tolist() == ids
    assert COUNTER.count(text) == len(ids)
    assert CODEC.decode(CODEC.encode(text)) == LIB.decode(ids, skip_special_tokens=False) == text


def test_pair_table_is_bounded(monkeypatch):
    import cabflow.llm.bpe_codec as m
    monkeypatch.setattr(m, "PAIR_ENTRIES", 200)
    r = random.Random(5)
    codec = Codec(VOCAB)
    for _ in range(60):
        text = "".join(r.choice("abcdefghij klmno") for _ in range(300))
        assert codec.encode(text).tolist() == lib_ids(text)
        assert len(codec.pairs) <= 200


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    ids = lib_ids(text)
    assert CODEC.encode(text).tolist() == ids
    assert COUNTER.count(text) == len(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="etaoinshrdlu ", max_size=200))
def test_letter_soup(text):
    assert CODEC.encode(text).tolist() == lib_ids(text)


def test_proven_strings_encode_as_one_token():
    some = random.Random(3).sample(sorted(COUNTER.whole), 500)
    assert all(merged_length(VOCAB, s.encode()) == 1 for s in some)
    assert all(len(CODEC.encode_piece(s.encode())) == 1 for s in some)


def test_decode_of_any_ids():
    ids = [random.Random(5).randrange(50257) for _ in range(3000)]
    import numpy as np

    assert CODEC.decode(np.array(ids)) == LIB.decode(ids, skip_special_tokens=False)


def test_frames(spark):
    rows = [(1, "hello world", "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0),
            (1, "hello world", "en", "a", 1), (None, "x<|endoftext|>y", "en", "a", 1), (4, "ab " * 50_000, "en", "a", 1)]
    docs = clashing(frame(spark, rows), "n_tokens", "ids", "n_bytes", "over_limit", "ids_sha256")
    got = sorted(map(tuple, token_counts(docs).collect()), key=str)
    want = sorted(((i, len((t or "").encode()), len(lib_ids(t or "")), len(lib_ids(t or "")) > 1024)
                   for i, t, *_ in rows), key=str)
    assert got == want
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = sorted(map(tuple, round_trip_digests(docs).collect()), key=str)
    assert got == sorted(((i, len(lib_ids(t or "")), sha(",".join(map(str, lib_ids(t or "")))), sha(t or ""))
                          for i, t, *_ in rows), key=str)
    back = decode(encode(docs)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in back), key=str) == sorted(((i, t or "") for i, t, *_ in rows), key=str)


def test_empty_table(spark):
    docs = frame(spark, [])
    assert token_counts(docs).count() == 0 and round_trip_digests(docs).count() == 0
