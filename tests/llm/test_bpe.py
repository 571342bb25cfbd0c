"""Encoding and decoding against the tokenizers library, and the defined cases."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowsift.llm import bpe
from flowsift.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(tokenizer_path())
ENCODER = bpe.Encoder(bpe.load(tokenizer_path()), tokenizer_path())


def expected(text: str) -> bytes:
    return np.array(LIBRARY.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(list("aabehst'01!- \n\t_") + ["é", "Σ", "ß", "ı", "İ", "́", "中", "한", "ᄒ", "ᅡ", "\xa0", "　",
                                        "<|endoftext|>", "<|", "|>", "'s", "'LL", "😀", "\x85", "\x1c", "​", "²", "٣", "</w>"]), max_size=24).map("".join))
def test_any_text(text):
    assert ENCODER.ids(text.encode()) == expected(text)


def test_words_of_few_letters():
    r = random.Random(4)
    for _ in range(500):
        word = "".join(r.choices(r.choice(["ab", "aeth", "etaoinshr", "0a", "-."]), k=r.randint(1, 90)))
        assert ENCODER.ids(word.encode()) == expected(word)


def test_every_token_that_counts_is_its_own_encoding():
    t = bpe.load(tokenizer_path())
    counted = set(t.token[t.token >= 0].tolist())
    assert len(counted) > 40_000
    merge = {}
    for i in range(t.leaves, len(t.left)):
        merge[int(t.left[i]) * len(t.left) + int(t.right[i])] = i
    assert len(merge) == len(t.left) - t.leaves


def test_long_word_and_text(spark):
    r = random.Random(8)
    texts = ["".join(r.choices("etaoinshrdlu", k=100_000)), "the quick, brown fox's 12 tails\n" * 20_000, "é" * 50_000]
    got = bpe.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tokenizer_path()).collect()
    assert [bytes(x.ids) for x in sorted(got)] == [expected(t) for t in texts]


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "One\x00 two", None), (4, " \t\n", "x"), (5, "A<|endoftext|>b", "x"), (5, "A<|endoftext|>b", "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(d, tokenizer_path()), tokenizer_path()).collect()
    want = [(i, len(expected(t or "")) // 4, LIBRARY.decode(LIBRARY.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False))
            for i, t, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.decode(bpe.encode(d.limit(0), tokenizer_path()), tokenizer_path()).count() == 0
    stray = spark.createDataFrame([(1, bytearray(np.array([320, 4_000_000_000, 49407], "<u4").tobytes())), (2, None)], "doc_id long, ids binary")
    known = LIBRARY.decode([320, 49407], skip_special_tokens=False)
    assert [tuple(r) for r in bpe.decode(stray, tokenizer_path()).collect()] == [(1, known), (2, "")]


def test_small_memories_change_nothing():
    r = random.Random(2)
    small = bpe.Encoder(bpe.load(tokenizer_path()), tokenizer_path())
    small.pieces.size, small.pieces.pairs.size = 5, 7
    for _ in range(100):
        text = " ".join("".join(r.choices("abcdefgh", k=r.randint(1, 9))) for _ in range(30))
        assert small.ids(text.encode()) == expected(text)
    assert len(small.pieces) <= 5 and len(small.pieces.older) <= 5


def test_other_tokenizers_are_refused(tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError):
        bpe.load(public_tokenizers.path("byte_bpe_50k.json"))


def test_query_equals_the_library(spark):
    import hashlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op11_bpe"](spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        e = LIBRARY.encode(text or "", add_special_tokens=False)
        decoded = LIBRARY.decode(e.ids, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(e.ids), hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
