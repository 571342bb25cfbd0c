"""Byte-pair encoding by one pass over prefixes, and decoding.

For every prefix of a piece exactly one vocabulary token ends its encoding. It is found among the tokens
that are suffixes of the prefix, longest first: the one that is compatible with the last token of what
stands before it. Two tokens are compatible if encoding their joined text gives these two again, which
the merges on the seam alone decide. Following the stored tokens back from the end of the piece gives its
ids. No merge queue is run, and a piece of any length takes time in proportion to it.

Suffix matches come from a suffix automaton of all vocabulary tokens (the states of a token's strings
are linked to those of its suffixes). It is built once on the driver from the tokenizer file, whose size
bounds it, and broadcast as arrays; tokens that encode to others are left out. Spark deals the texts out;
a task keeps a bounded memory of pieces and of compatible pairs. Texts are normalized and cut into pieces
by the tokenizer's own pattern; those beyond Latin, Greek and Cyrillic letters by the tokenizers library.

The tokenizer must be a BPE whose ids follow its merges and which lower-cases and cuts texts
as the public one used here; any other configuration raises ``ValueError``.

Defined cases: null and empty texts have no ids and decode to the empty text; special tokens' strings in
a text are their ids, as in the library; a null id is returned as null; repeated rows are each encoded;
very long texts and words are handled whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shipped

#: Normalizers and pre-tokenizer (fixed values of the public tokenizer) under which a text is cut into words here.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECE = regex.compile(PATTERN)
#: Texts of ASCII, Latin, Greek and Cyrillic are normalized and cut here; the library does the same far more slowly.
SIMPLE = re.compile(r"[\t-\r -~\u00a1-\u052f]*")
#: Pieces and pairs of tokens that a Python worker remembers (twice as many at most).
PIECES, PAIRS = 250_000, 500_000
NEVER = 1 << 60


def seam_holds(merge: dict[int, int], left: list[int], right: list[int], leaves: int, width: int, a: int, b: int, before: int = NEVER) -> bool:
    """Whether tokens ``a`` and ``b`` side by side stay apart when merges run (up to rank ``before``).

    Going back in time, the younger of the two tokens at the seam is split until both are symbols. A merge
    of two tokens at the seam would have come first if its rank is below that of the merge that took the
    left one (merges run from the left), or not above that of the merge that took the right one."""
    a_taken = b_taken = before
    while True:
        m = merge.get(a * width + b)
        if m is not None and m < a_taken and m <= b_taken and m < before:
            return False
        if a < leaves and b < leaves:
            return True
        if a > b:  # ids of merged tokens follow the ranks
            a_taken, a = a, right[a]
        else:
            b_taken, b = b, left[b]


@dataclass
class Tables:
    """What encoding needs, as arrays: merges, the suffix automaton and the tokens' strings."""

    leaves: int
    left: np.ndarray
    right: np.ndarray
    strings: list[str]
    specials: dict[str, int]
    edge_from: np.ndarray  # state * leaves + symbol
    edge_to: np.ndarray
    length: np.ndarray
    link: np.ndarray
    token: np.ndarray  # token that is the state's longest string, or -1


def suffix_automaton(sequences: list[tuple[int, list[int]]], leaves: int) -> tuple[dict[int, int], list[int], list[int], list[int]]:
    """(edges, lengths, suffix links, tokens) of the automaton of all factors of the sequences. A whole sequence is
    always the longest string of its state."""
    go: list[dict[int, int]] = [{}]
    length, link, token = [0], [-1], [-1]

    def state(n: int, edges: dict[int, int], suffix: int) -> int:
        go.append(edges)
        length.append(n)
        link.append(suffix)
        token.append(-1)
        return len(go) - 1

    def split(p: int, q: int, c: int) -> int:
        """The state of the strings of ``q`` that are ``p``'s longest followed by ``c``, or their suffixes."""
        if length[q] == length[p] + 1:
            return q
        r = state(length[p] + 1, dict(go[q]), link[q])
        link[q] = r
        while p >= 0 and go[p].get(c) == q:
            go[p][c] = r
            p = link[p]
        return r

    for t, symbols in sequences:
        last = 0
        for c in symbols:
            p = last
            if c in go[p]:
                last = split(p, go[p][c], c)
                continue
            last = state(length[p] + 1, {}, 0)
            while p >= 0 and c not in go[p]:
                go[p][c] = last
                p = link[p]
            if p >= 0:
                suffix = split(p, go[p][c], c)
                link[last] = suffix
        token[last] = t
    return {s * leaves + c: q for s, edges in enumerate(go) for c, q in edges.items()}, length, link, token


def load(path: str) -> Tables:
    """The tables of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    model = config["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    vocabulary: dict[str, int] = model["vocab"]
    leaves = len(vocabulary) - len(merges)
    splits = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
    known = (model["type"] == "BPE" and model.get("end_of_word_suffix") == "</w>"
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
             and [n["type"] for n in (config.get("normalizer") or {}).get("normalizers", [])] == NORMALIZERS
             and [p["type"] for p in splits] == ["Split", "ByteLevel"] and splits[0]["pattern"].get("Regex") == PATTERN
             and config.get("decoder") is None
             and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in config.get("added_tokens", [])))
    known = known and sorted(vocabulary.values()) == list(range(len(vocabulary)))
    known = known and all(vocabulary.get(a + b) == leaves + rank for rank, (a, b) in enumerate(merges))
    if not known:
        raise ValueError(f"{path}: not a lower-casing byte-level BPE with word ends whose ids follow its merges")
    left = [-1] * leaves + [vocabulary[a] for a, _ in merges]
    right = [-1] * leaves + [vocabulary[b] for _, b in merges]
    width = len(vocabulary)
    merge = {left[t] * width + right[t]: t for t in range(leaves, width)}
    own: list[list[int] | None] = [[t] for t in range(leaves)]
    for t in range(leaves, width):  # a token counts if its parts do and they meet before any other merge takes them
        a, b = left[t], right[t]
        fits = own[a] is not None and own[b] is not None and seam_holds(merge, left, right, leaves, width, a, b, t)
        own.append(own[a] + own[b] if fits else None)
    edges, length, link, token = suffix_automaton([(t, s) for t, s in enumerate(own) if s], leaves)
    strings = [""] * width
    for s, t in vocabulary.items():
        strings[t] = s
    specials = {t["content"]: t["id"] for t in config.get("added_tokens", [])}
    extra = {i: s for s, i in specials.items()}
    strings += [extra.get(i, "") for i in range(width, max(extra, default=-1) + 1)]
    return Tables(leaves, np.array(left, np.int32), np.array(right, np.int32), strings, specials,
                  np.fromiter(edges.keys(), np.int64, len(edges)), np.fromiter(edges.values(), np.int32, len(edges)),
                  np.array(length, np.int32), np.array(link, np.int32), np.array(token, np.int32))


class Remembered(dict):
    """A memory of bounded size: when it is full it becomes the older half, of which what is used again returns."""

    def __init__(self, size: int) -> None:
        super().__init__()
        self.size, self.older = size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value

    def make(self, key):
        raise NotImplementedError


class Pairs(Remembered):
    """Whether two tokens (first * width + second) are compatible."""

    def __init__(self, t: Tables) -> None:
        super().__init__(PAIRS)
        self.left, self.right, self.leaves, self.width = t.left.tolist(), t.right.tolist(), t.leaves, len(t.left)
        self.merge = {self.left[i] * self.width + self.right[i]: i for i in range(self.leaves, self.width)}

    def make(self, key: int) -> bool:
        return seam_holds(self.merge, self.left, self.right, self.leaves, self.width, *divmod(key, self.width))


class Pieces(Remembered):
    """Ids (little-endian unsigned 32-bit) of normalized pieces."""

    def __init__(self, t: Tables) -> None:
        super().__init__(PIECES)
        self.pairs, self.width, self.leaves = Pairs(t), len(t.left), t.leaves
        self.edges = dict(zip(t.edge_from.tolist(), t.edge_to.tolist()))
        self.length, self.link = t.length.tolist(), t.link.tolist()
        self.own = t.token.tolist()
        self.token_length = [0] * self.width
        for s, token in enumerate(self.own):
            if token >= 0:
                self.token_length[token] = self.length[s]
        self.suffixes: dict[int, tuple[int, ...]] = {0: (), -1: ()}
        symbol = {s: i for i, s in enumerate(t.strings[: t.leaves])}
        chars = byte_chars()
        self.inner, self.last = [symbol[c] for c in chars], [symbol[c + "</w>"] for c in chars]

    def ending(self, state: int) -> tuple[int, ...]:
        """Tokens that end the longest string of a state, longest first."""
        found = self.suffixes.get(state)
        if found is None:
            token = self.own[state]
            found = ((token,) if token >= 0 else ()) + self.ending(self.link[state])
            self.suffixes[state] = found
        return found

    def make(self, piece: str) -> bytes:
        data = piece.encode()
        symbols = [self.inner[b] for b in data[:-1]]
        symbols.append(self.last[data[-1]])
        edges, link, length, leaves, width = self.edges, self.link, self.length, self.leaves, self.width
        pairs, token_length, suffixes = self.pairs, self.token_length, self.suffixes
        last = [-1]  # the last token of each prefix
        state = matched = 0
        for end, c in enumerate(symbols, 1):
            to = edges.get(state * leaves + c)
            while to is None:
                state = link[state]
                matched = length[state]
                to = edges.get(state * leaves + c)
            state, matched = to, matched + 1
            whole = state if matched == length[state] else link[state]
            for token in suffixes.get(whole) or self.ending(whole):
                before = last[end - token_length[token]]
                if before < 0 or pairs[before * width + token]:
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends byte {end} of {piece!r}")
        ids, end = [], len(symbols)
        while end:
            ids.append(last[end])
            end -= token_length[last[end]]
        return struct.pack(f"<{len(ids)}I", *reversed(ids))


def byte_chars() -> list[str]:
    """Byte-level alphabet: the character of each byte. Printable bytes stand for themselves, the others follow from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = itertools.count(256)
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def normalized(text: str) -> str:
    """A text of the characters of :data:`SIMPLE`, as the tokenizer's normalizers leave it (white space apart)."""
    return unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()  # no final sigma there


class Encoder:
    """Ids of texts."""

    def __init__(self, t: Tables, path: str) -> None:
        from tokenizers import Tokenizer

        self.pieces, self.library = Pieces(t), Tokenizer.from_file(path)
        self.specials = {s: struct.pack("<I", i) for s, i in t.specials.items()}
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None

    def cut(self, text: str) -> list[str]:
        """The normalized pieces of a text."""
        if SIMPLE.fullmatch(text):
            return PIECE.findall(normalized(text))
        normal = self.library.normalizer.normalize_str(text)
        return [normal[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def ids(self, data: bytes | None) -> bytes:
        text = (data or b"").decode("utf-8", "replace")
        parts = self.special.split(text) if self.special else [text]
        return b"".join([self.specials[p] if p in self.specials else b"".join(map(self.pieces.__getitem__, self.cut(p)))
                         for p in parts])


#: One encoder for each tokenizer file in a Python worker, kept between its tasks.
_ENCODERS: dict[str, Encoder] = {}


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each text: (doc_id, n_tokens, ids); ids are little-endian unsigned 32-bit integers."""
    tables = docs.sparkSession.sparkContext.broadcast(load(tokenizer_path))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _ENCODERS:
            _ENCODERS[tokenizer_path] = Encoder(tables.value, tokenizer_path)
        encoder = _ENCODERS[tokenizer_path]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                ids = [encoder.ids(x) for x in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "n_tokens", "ids"])

    d = shipped(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return d.mapInArrow(encoded, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded`` in place of the ids: the tokens' strings joined by one space, as the library
    decodes without a decoder. Ids that the tokenizer does not know are left out, as there."""
    schema = [f for f in encoded.schema.fields if f.name != ids_col]
    names = [f.name for f in schema]
    strings = _strings(tokenizer_path)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                texts = []
                for data in b.column(ids_col).to_pylist():
                    ids = np.frombuffer(data or b"", dtype="<u4")
                    if len(ids) and (int(ids.max()) >= len(strings) or not all(map(strings.__getitem__, np.unique(ids).tolist()))):
                        ids = ids[[i < len(strings) and bool(strings[i]) for i in ids.tolist()]]
                    texts.append(" ".join(map(strings.__getitem__, ids.tolist())))
                yield pa.RecordBatch.from_arrays([b.column(n) for n in names] + [pa.array(texts, pa.string())], [*names, "decoded"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return encoded.mapInArrow(decoded, f"{types}, decoded string")


def _strings(path: str) -> list[str]:
    """Each id's token; empty where there is none."""
    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    ids = dict(config["model"]["vocab"]) | {t["content"]: t["id"] for t in config.get("added_tokens", [])}
    out = [""] * (max(ids.values(), default=-1) + 1)
    for s, i in ids.items():
        out[i] = s
    return out
