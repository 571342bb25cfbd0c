"""Words of op7 (packing): cut and looked up as arrays, ids as those of whole texts."""

import random

import numpy as np
import pyarrow as pa
import pytest

from flowsift.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")


def words():
    return packing.Words(public_tokenizers.path("word_bpe_49k.json"))


def test_arrays_of_words_equal_whole_texts():
    known, r = words(), random.Random(11)
    letters = "abcZQ'sdtlrevm019.,!\"#<|>`~[]{}@éİΣςσßЖжñ中文あ한́ \t\n\x0b\x0c\r\x1c\x85-_ \U0001f642"
    texts = ["".join(r.choices(letters, k=r.randint(0, 60))) for _ in range(3000)]
    texts += [None, "", "  ", "a,", "a,'s b's, 'tis, WE'LL!'re", "x) y), z,) <|endoftext|>B, C.", "a,<|endoftext|>b", "É, é. á, ,a", "x," * 3000]
    for at in range(0, len(texts), 500):  # a slice of a longer column, as batches are cut
        part = texts[at: at + 500]
        ids, n = known.coded(*packing._words(pa.array(texts, pa.string()).slice(at, 500), known.known))
        ends = np.cumsum(n)
        for text, a, b in zip(part, ends - n, ends):
            assert ids[a:b].tolist() == known.tokenizer.encode(text or "", add_special_tokens=False).ids, text


def test_a_word_is_learned_once_whatever_mark_follows():
    known = words()
    ids, n = known.coded(*packing._words(pa.array(["Word, word. (word) word; word", "word: WORD!"]), known.known))
    assert n.tolist() == [len(known.tokenizer.encode(t, add_special_tokens=False).ids) for t in ("Word, word. (word) word; word", "word: WORD!")]
    assert sum(b"word" in w for w in known) == 2  # the plain word, and the one behind a bracket


def test_batches_are_cut_by_rows_and_bytes(monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 3)
    monkeypatch.setattr(packing, "SLICE_BYTES", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(["a", None, "b", "c" * 40, "", "d" * 6, "e" * 6, "f"])], ["doc_id", "text"])
    parts = list(packing._slices(batch, 1))
    assert pa.Table.from_batches(parts).column(0).to_pylist() == list(range(8))
    assert all(1 <= p.num_rows <= 3 for p in parts) and len(parts) >= 3
