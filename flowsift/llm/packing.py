"""Packing documents into fixed-length sequences along a space-filling curve.

Each text is tokenized once; the ids' hashed vector (a signed random projection of the token
counts) is a few numbers. Vectors are standardised by statistics over all documents and ordered by
Hilbert key. Documents follow one another along the curve and the stream is cut every ``length``
ids, so neighbours share sequences and only the last sequence has padding.

Places in the stream: (key, row) is range-partitioned and sorted (the row number breaks ties, so a
third of all documents with one key still spreads), each partition counts its own places, and the
partitions' totals (one row each) give the offsets. Only narrow rows are sorted; the ids move once,
to meet their place. Tokenizing is never repeated: its output is a scratch table.

Words are tokenized through a bounded memory of words already seen (kept by each Python worker);
that is exact for tokenizers that lower-case and never join text across white space, as the one used
here. New words of ASCII, Latin, Greek and Cyrillic characters are cut into pieces here, a batch at a
time, and new pieces go straight to the tokenizer's merges; all other words, and every word where the
tokenizer's configuration is not the known one, go through the whole tokenizer. Tests compare it with
whole texts.

Defined cases: null and empty texts are the closing id alone; a null id is returned as null;
repeated rows are packed each; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bpe import NORMALIZERS, PATTERN, SIMPLE, byte_chars, normalized
from .common import scratch, shipped
from .hashing import U, mix
from .hilbert import hilbert_keys, to_cells

DIMENSIONS, BITS = 4, 12
REMEMBERED_WORDS = 400_000
#: Texts whose words are looked up together: most rows, and bytes beyond which a part ends.
SLICE_ROWS, SLICE_BYTES = 1024, 8_000_000
#: Most ids whose packed projections are summed at once (16 bits a lane, up to 2 for each id).
LANE = 30_000


def projection(ids: np.ndarray) -> np.ndarray:
    """Signed hashed projection of each id: DIMENSIONS values 0 or 2 (for -1 and +1), 16 bits each, in
    one integer, so that a document's vector takes one lookup and one sum."""
    h = mix(ids.astype(U) + U(977))
    out = np.zeros(len(ids), dtype=U)
    for i in range(DIMENSIONS):
        out |= ((h >> U(i)) & U(1)) << U(16 * i + 1)
    return out


def vectors(ids: np.ndarray, n: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Mean projection of each document's ids; ``ids`` holds those of all documents, ``n`` their numbers (at least 1).
    Lanes are added up in stretches that cannot overflow."""
    starts = np.cumsum(n) - n
    stretches = -(-n // LANE)
    owner = np.repeat(np.arange(len(n)), stretches)
    at = starts[owner] + LANE * (np.arange(len(owner)) - np.repeat(np.cumsum(stretches) - stretches, stretches))
    packed = np.add.reduceat(table[ids], at)
    out = np.zeros((len(n), DIMENSIONS))
    for k in range(DIMENSIONS):
        out[:, k] = np.bincount(owner, weights=((packed >> U(16 * k)) & U(0xFFFF)).astype(float), minlength=len(n))
    return out / n[:, None] - 1


#: The tokenizer's pieces, and the ends of words that are cut together.
CUT = regex.compile(PATTERN + r"|\n")
#: An ASCII letter and a mark behind it; not the apostrophe, with which a piece may begin in several ways.
LETTER_MARK = r"([a-z])([!-&(-/:-@\[-`{-~])"
#: Stands for the end of a word among ids (no tokenizer has that many).
END = 0xFFFFFFFF


class Words(dict):
    """Token ids (little-endian unsigned 32-bit) of each word, remembered up to a bound: the fuller half turns
    into the older one, and words met again come back from there, so frequent words are never learned anew."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.chars = self.tokenizer.model, dict(enumerate(byte_chars()))
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        normalizers = [n["type"] for n in (config.get("normalizer") or {}).get("normalizers", [])]
        splits = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.known = (normalizers == NORMALIZERS and [p["type"] for p in splits] == ["Split", "ByteLevel"]
                      and splits[0]["pattern"].get("Regex") == PATTERN)
        self.older: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def ids(self, texts: list[list[bytes]]) -> list[bytes]:
        """Ids of each text, given as words."""
        every, n = self.coded(pa.array(itertools.chain.from_iterable(texts), pa.binary()), np.array([len(t) for t in texts], dtype=np.int64))
        ends = np.cumsum(n)
        return [every[a:b].tobytes() for a, b in zip(ends - n, ends)]

    def coded(self, words: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, their number in each); ``words`` holds those of all texts, ``counts`` their numbers.
        One look into the memory for every different word; the ids of its places are gathered as arrays."""
        coded = words.dictionary_encode()
        different = coded.dictionary
        # words hold no space: one join and one split hand them over far faster than value by value
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(different)], pa.int32()), different), b" ")[0].as_py()
        known = self.known_ids(joined.split(b" ") if len(different) else [])
        place, size = coded.indices.to_numpy(), np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        pool, first = np.frombuffer(b"".join(known), dtype="<u4"), np.cumsum(size) - size
        each = size[place]
        ends = np.concatenate([[0], np.cumsum(each)])
        every = pool[np.arange(ends[-1]) + np.repeat(first[place] - ends[:-1], each)]
        return every, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])

    def known_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of different words, learned where the memory does not hold them."""
        if len(self) > REMEMBERED_WORDS:
            self.older = dict(self)
            self.clear()
        found = list(map(self.get, words))
        missing = {w for w, k in zip(words, found) if k is None}
        if not missing:
            return found
        self.learn(missing)
        return [self[w] if k is None else k for w, k in zip(words, found)]

    def learn(self, words: set[bytes]) -> None:
        """Takes words into the memory, from its older half or anew."""
        new = []
        for w in words:
            if w in self.older:
                self[w] = self.older[w]
            else:
                new.append(w)
        if not new:
            return
        alone: list[bytes] = []
        if not self.known:
            alone, new = new, []
        text = b"\n".join(new).decode("utf-8", "replace")
        if not SIMPLE.fullmatch(text) or "<|" in text:  # other scripts, or perhaps a special token
            simple = [SIMPLE.fullmatch(t) is not None and "<|" not in t for t in text.split("\n")]
            alone += [w for w, s in zip(new, simple) if not s]
            new = [w for w, s in zip(new, simple) if s]
            text = b"\n".join(new).decode("utf-8", "replace")
        if new:
            self.merge(new, normalized(text))
        texts = [w.decode("utf-8", "replace") for w in alone]
        for w, e in zip(alone, self.tokenizer.encode_batch(texts, add_special_tokens=False)):
            self[w] = np.array(e.ids, dtype="<u4").tobytes()

    def merge(self, words: list[bytes], text: str) -> None:
        """Ids of words that are cut into pieces together; only new pieces go to the tokenizer's merges."""
        found = CUT.findall(text)
        if len(self.pieces) > REMEMBERED_WORDS:
            self.pieces.clear()
        self.pieces["\n"] = struct.pack("<I", END)
        fresh = [p for p in set(found) if p not in self.pieces]
        tokens = [self.model.tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(self.chars)) for p in fresh]
        data = np.array([t.id for ts in tokens for t in ts], dtype="<u4").tobytes()
        at = 0
        for p, ts in zip(fresh, tokens):
            self.pieces[p] = data[at: at + 4 * len(ts)]
            at += 4 * len(ts)
        data = b"".join(map(self.pieces.__getitem__, found))
        ends = 4 * np.flatnonzero(np.frombuffer(data, dtype="<u4") == END)
        at = 0
        for w, end in zip(words, [*ends.tolist(), len(data)]):
            self[w] = data[at:end]
            at = end + 4


#: One memory for each tokenizer in a Python worker, kept between its tasks.
_KNOWN: dict[str, Words] = {}


def _split(text: bytes | None) -> list[bytes]:
    """Words at ASCII white space, A-Z lower-cased as the tokenizer will (not where the text may hold
    a special token's string)."""
    data = text or b""
    return (data if b"<|" in data else data.lower()).split()


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most SLICE_ROWS rows, and of little more than SLICE_BYTES of a column unless one row has more."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        end = min(at + SLICE_ROWS, max(at + 1, int(np.searchsorted(size, before + SLICE_BYTES))))
        yield batch.slice(at, end - at)
        at = end


def _words(texts: pa.Array, apart: bool) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts, their number in each), as :func:`_split` cuts them; with ``apart``, which the known
    tokenizer allows, also where its pieces end between a letter and a mark, so that a word is learned once."""
    texts = pc.fill_null(texts, "")
    lower = pc.ascii_lower(texts)
    if apart:
        lower = pc.replace_substring_regex(lower, LETTER_MARK, r"\1 \2")
    texts = pc.if_else(pc.match_substring(texts, "<|"), texts, lower)
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    filled = pc.greater(pc.binary_length(words), 0)  # white space at either end leaves an empty one
    ends = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
    counts = np.diff(ends[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])])
    return words.filter(filled).cast(pa.binary()), counts


def tokenized(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, n, v, ids): one row for each document; ids as unsigned 32-bit, end id included."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _KNOWN:
            _KNOWN[path] = Words(path)
        known = _KNOWN[path]
        rows = itertools.count(TaskContext.get().partitionId() << 36)
        table = np.empty(0, dtype=U)
        for b in batches:
            for part in _slices(b, 1):
                ids, n = known.coded(*_words(part.column(1), known.known))
                ends = np.cumsum(n + 1)
                every = np.full(ends[-1], end_id, dtype="<u4")
                inside = np.ones(len(every), dtype=bool)
                inside[ends - 1] = False
                every[inside] = ids
                if int(every.max()) >= len(table):
                    table = projection(np.arange(max(1024, 2 * int(every.max()))))
                v = vectors(every, n + 1, table)
                offsets = np.concatenate([[0], 4 * ends]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(itertools.islice(rows, part.num_rows), pa.int64()), part.column(0), pa.array(n + 1, pa.int64()),
                     pa.array(v.tolist(), pa.list_(pa.float64())),
                     pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(every)])],
                    ["row", "doc_id", "n", "v", "ids"])

    d = shipped(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return scratch(d.mapInArrow(read, "row long, doc_id long, n long, v array<double>, ids binary"), "pack-ids")


def places(tokens: DataFrame) -> DataFrame:
    """(row, start): each row's first place in the stream."""
    stats = tokens.agg(*[f(F.get("v", F.lit(i))).alias(f"{name}{i}") for i in range(DIMENSIONS)
                         for name, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([stats[f"m{i}"] or 0.0 for i in range(DIMENSIONS)])
    spread = np.array([stats[f"s{i}"] or 0.0 for i in range(DIMENSIONS)])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = np.array(b.column(2).to_pylist(), dtype=float).reshape(-1, DIMENSIONS)
            key = hilbert_keys(to_cells(v, mean, spread, BITS), BITS)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(key, pa.int64())], ["row", "n", "key"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.column(1).to_numpy()
            ends = total + np.cumsum(n)
            total = int(ends[-1]) if len(ends) else total
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(ends - n, pa.int64()), pa.array([part] * len(n), pa.int32())],
                ["row", "n", "local", "part"])

    k = tokens.select("row", "n", "v").mapInArrow(keyed, "row long, n long, key long")
    k = k.repartitionByRange("key", "row").sortWithinPartitions("key", "row").select("row", "n")
    k = scratch(k.mapInArrow(counted, "row long, n long, local long, part int"), "pack-order")
    totals = k.groupBy("part").agg(F.sum("n").alias("total"))
    before = F.sum("total").over(W.orderBy("part")) - F.col("total")  # one row for each partition
    offsets = totals.select(F.col("part"), before.alias("before"))
    return k.join(F.broadcast(offsets), "part").select("row", (F.col("local") + F.col("before")).alias("at"))


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "ids binary")


def pack(docs: DataFrame, tokenizer_path: str, length: int = 4096, end_id: int = 2, with_ids: bool = True,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece of a document in a sequence: (doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, ids); ``ids`` (unsigned 32-bit) is null unless ``with_ids``."""
    tokens = tokenized(docs, tokenizer_path, end_id, id_col, text_col)
    # the narrow side is hashed, so the ids are not sorted to meet their places
    placed = tokens.select("row", "doc_id", "ids").join(places(tokens).hint("shuffle_hash"), "row").select("doc_id", "ids", "at")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for doc, data, at in zip(*(b.column(i).to_pylist() for i in range(3))):
                n, start = len(data) // 4, 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    size = min(n - start, length - offset)
                    piece = data[4 * start: 4 * (start + size)]
                    out.append((doc, start, size, zlib.crc32(piece), n, sequence, offset, piece if with_ids else None))
                    start += size
            types = [pa.int64()] * 7 + [pa.binary()]
            columns = list(zip(*out)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    return placed.mapInArrow(cut, PIECES)
