"""Substring dedup by recompression.

A text's words are rewritten in rounds. First short runs of one word become one symbol; then, round
by round, every symbol falls by a hash of its name into a left or a right class, and each left symbol
followed by a right one becomes a pair symbol. Names are 64-bit hashes of what a symbol replaces, so
they are global without a dictionary: equal substrings get the same symbols on every executor, but
for a few at their rims whose fate depends on neighbours outside.

How far that dependence reaches is tracked exactly: each symbol carries the stretch of words that
fixes it. A window of ``width`` words that holds such a stretch holds the symbol wherever the window
occurs, so the symbol *serves* the window. Symbols of the highest level serve first, windows left
over are served by the next level, and level 0 (the words) serves all: no repeat can be missed.

1. Each window is given to the serving symbols with the smallest and the largest name; consecutive
   windows of one such pair form a run. Each text emits its runs with a 96-bit hash of their words, in one pass.
2. Equal runs need no window rows: every window of a later holder is a repeat. Only where symbols
   head different runs do the first holders' windows get 96-bit names of their own; the smallest
   document of each name is found by an aggregation, and a window of a larger one is a repeat.
3. Texts that lose words meet their repeats and are cut.

Whole-text copies (equal word sequences) are settled by one hash, and a group of copies or a passage
in a third of all texts is only ever counted by combined minima.

Defined cases: null and empty texts have no words; rows without an id lose nothing and take nothing;
rows that share an id are judged against smaller ids only; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, doc_key, join_key, scratch, shipped
from .hashing import U, WordHashes, constants, mix, split_words, windows

WIDTH = 50
ROUNDS = 5
#: Longest run that becomes one symbol, and most words in a symbol.
RUN, CAP = 6, 20
SEEDS = constants(2 * ROUNDS + 4, 31)


def run_round(sym: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(symbol, start, low, high) after the run round; ``first`` marks the texts' first words."""
    n = len(sym)
    at = np.flatnonzero(first | np.concatenate([[True], sym[1:] != sym[:-1]]))
    length = np.diff(np.append(at, n))
    short = length <= RUN
    owner = np.repeat(np.arange(len(at)), length)
    stays = ~short[owner]
    stays[at] = True
    start = np.flatnonzero(stays)
    run = owner[start]
    name = np.where(short[run] & (length[run] > 1), mix(sym[start] * SEEDS[0] + length[run].astype(U)), sym[start])
    low, high = at[run] - 1, at[run] + length[run] + 1
    long = ~short[run]
    low[long] = np.maximum(low[long], start[long] - RUN - 1)
    high[long] = np.minimum(high[long], start[long] + RUN + 2)
    return name, start, low, high


def pair_round(sym, start, low, high, doc, begin, end, n, t):
    """One round of pair replacement; the same arrays, shorter."""
    right = (mix(sym + SEEDS[t]) >> U(63)).astype(bool)
    size = np.diff(np.append(start, n))
    near = np.append(doc[1:] == doc[:-1], False)  # the next symbol belongs to the same text
    pair = np.zeros(len(sym), dtype=bool)
    pair[:-1] = ~right[:-1] & right[1:] & near[:-1] & (size[:-1] + size[1:] <= CAP)
    after_low, after_high = np.append(low[1:], 0), np.append(high[1:], 0)
    before_low, before_high = np.append(0, low[:-1]), np.append(0, high[:-1])
    has_before = np.append(False, near[:-1])
    # a left symbol's fate hangs on what follows, a right one's on what precedes; a text's rim counts
    # as a neighbour that lies outside every window
    other_low = np.where(right, np.where(has_before, before_low, begin[doc] - 1), np.where(near, after_low, low))
    other_high = np.where(right, np.where(has_before, before_high, high), np.where(near, after_high, end[doc] + 1))
    new_low, new_high = np.minimum(low, other_low), np.maximum(high, other_high)
    name = np.where(pair, mix(sym * SEEDS[ROUNDS + t] + np.append(sym[1:], U(0))), sym)
    keep = ~np.append(False, pair[:-1])
    return name[keep], start[keep], new_low[keep], new_high[keep], doc[keep]


def power_sums(h: np.ndarray, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and inverse powers for hashing any stretch of ``h`` as a polynomial modulo 2^64."""
    inverse = U(pow(int(base), -1, 1 << 64))
    powers = np.cumprod(np.append(U(1), np.full(len(h), base)))
    backs = np.cumprod(np.append(U(1), np.full(len(h), inverse)))
    return np.append(U(0), np.cumsum(mix(h) * powers[:-1])), backs


def anchors(hashes: np.ndarray, lengths: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """(text, name, u1, u2, first, count) of the runs of windows with the same designated symbols, for
    several texts whose word hashes stand one after another.

    A window's designated symbols are those with the smallest and the largest name among the symbols
    that serve it at the highest level that has any: a choice that the window's own words fix. Both
    together are the run's name, so a phrase that many texts share does not make candidates alone. ``first`` is the run's
    first window, counted by its first word in the text; u1 and u2 hash all words of the run."""
    n = len(hashes)
    end = np.cumsum(lengths)
    begin = end - lengths
    doc = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(n)
    open_ = place + width <= end[doc]
    if not open_.any():
        return tuple(np.empty(0, dtype=t) for t in (int, U, U, U, int, int))
    sym = mix(hashes)
    levels = [(sym, place, place, place + 1, doc)]
    name, start, low, high = run_round(sym, place == begin[doc])
    levels.append((name, start, low, high, doc[start]))
    for t in range(1, ROUNDS + 1):
        levels.append(pair_round(*levels[-1], begin, end, n, t))
    chosen, other = np.full(n, ~U(0), dtype=U), np.zeros(n, dtype=U)
    mine = open_.copy()
    for level in range(len(levels) - 1, -1, -1):
        sym, start, low, high, d = levels[level]
        a, b = np.maximum(high - width, begin[d]), np.minimum(low, end[d] - width)
        i = np.flatnonzero(a <= b)
        before = np.append(0, np.cumsum(open_))
        i = i[before[b[i] + 1] > before[a[i]]]
        count = b[i] - a[i] + 1
        at = np.repeat(a[i] - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(int(count.sum()))
        names = np.repeat(mix(sym[i] + U(level)), count)
        still = open_[at]
        np.minimum.at(chosen, at[still], names[still])
        np.maximum.at(other, at[still], names[still])
        open_[at] = False
        if not open_.any():
            break
    chosen = mix(chosen * SEEDS[-3] + other)
    w = np.flatnonzero(mine)
    new = np.append(True, (chosen[w[1:]] != chosen[w[:-1]]) | (w[1:] != w[:-1] + 1))
    first = w[new]
    count = np.diff(np.append(np.flatnonzero(new), len(w)))
    size = count + (width - 1)
    u = []
    for k in (0, 1):
        sums, backs = power_sums(hashes, SEEDS[-1 - k])
        u.append(mix((sums[first + size] - sums[first]) * backs[first] + size.astype(U)))
    return doc[first], chosen[first], u[0], u[1], first - begin[doc[first]], count


def _digest(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).digest()


SCANNED = ("row long, k_id long, k_h1 long, k_h2 int, n long, sha binary, "
           "name long, u1 long, u2 int, first int, count int")


def scan(keyed: DataFrame, width: int) -> DataFrame:
    """One row for each text (``sha`` set) and one for each of its runs of windows (``name`` set)."""
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in SCANNED.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        numbers = itertools.count(TaskContext.get().partitionId() << 36)
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                b = whole.slice(at, 128)
                words = [split_words(x) for x in b.column(3).to_pylist()]
                row = np.fromiter(itertools.islice(numbers, b.num_rows), dtype=np.int64)
                n = np.array([len(w) for w in words])
                h = np.concatenate([known.of(w) for w in words]) if len(words) else np.empty(0, U)
                runs = anchors(h, n, width)
                taking = ~np.array(b.column(0).is_null()) if b.num_rows else np.empty(0, bool)
                text, name, u1, u2, first, count = (x[taking[runs[0]]] for x in runs)
                ids = b.column(0).to_numpy(zero_copy_only=False)[text].astype(np.int64)
                k, m = b.num_rows, len(text)
                values = {"row": pa.array(row), "k_id": b.column(0), "k_h1": b.column(1), "k_h2": b.column(2), "n": pa.array(n, pa.int64()),
                          "sha": pa.array([_digest(w) for w in words], pa.binary())}
                yield pa.RecordBatch.from_arrays([values.get(f.name, pa.nulls(k, f.type)) for f in schema], schema=schema)
                values = {"row": pa.array(row[text]), "k_id": pa.array(ids), "name": pa.array(name.view(np.int64)), "u1": pa.array(u1.view(np.int64)),
                          "u2": pa.array((u2 >> U(33)).astype(np.int32)), "first": pa.array(first, pa.int32()), "count": pa.array(count, pa.int32())}
                yield pa.RecordBatch.from_arrays([values.get(f.name, pa.nulls(m, f.type)) for f in schema], schema=schema)

    return keyed.select(*KEY, "text").mapInArrow(read, SCANNED)


def squeeze(keyed: DataFrame) -> DataFrame:
    """Texts as compressed UTF-8, for the one shuffle that moves them."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            z = [press((x or "").encode("utf-8", "surrogatepass")) for x in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(z, pa.binary())], [*KEY, "z"])

    return keyed.select(*KEY, "text").mapInArrow(read, "k_id long, k_h1 long, k_h2 int, z binary")


def _words(z: bytes) -> list[bytes]:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(z).split()


def candidate_windows(texts: DataFrame, width: int) -> DataFrame:
    """(w1, w2, doc_id, row, at) of every window of the runs in ``spans``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in batches:
            for row, doc, z, spans in zip(*(b.column(i).to_pylist() for i in range(4))):
                h = known.of(_words(z))
                w1, w2 = windows(h, width), windows(h, width, seed=7)
                mark = np.zeros(len(w1) + 1, dtype=np.int64)
                for s in spans:
                    mark[s["first"]] += 1
                    mark[s["first"] + s["count"]] -= 1
                at = np.flatnonzero(np.cumsum(mark)[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1[at].view(np.int64)), pa.array((w2[at] >> U(33)).astype(np.int32)), pa.array([doc] * len(at), pa.int64()),
                     pa.array([row] * len(at), pa.int64()), pa.array(at, pa.int32())], ["w1", "w2", "doc_id", "row", "at"])

    return texts.select("row", "doc_id", "z", "spans").mapInArrow(read, "w1 long, w2 int, doc_id long, row long, at int")


def cut(texts: DataFrame, width: int) -> DataFrame:
    """(row, gone, kept): number of words removed and the kept words joined by one space. ``direct``
    holds runs of repeated windows, ``ats`` single ones."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, gone, kept = [], [], []
            for row, z, direct, ats in zip(*(b.column(i).to_pylist() for i in range(4))):
                words = _words(z)
                mark = np.zeros(len(words) + width + 1, dtype=np.int64)
                runs = [(s["first"], s["first"] + s["count"] - 1 + width) for s in direct or ()] + [(x, x + width) for x in ats or ()]
                for i, j in runs:
                    mark[i] += 1
                    mark[j] -= 1
                stays = np.flatnonzero(np.cumsum(mark)[: len(words)] == 0)
                rows.append(row)
                gone.append(len(words) - len(stays))
                kept.append(b" ".join([words[i] for i in stays]).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                             ["row", "gone", "kept"])

    return texts.select("row", "z", "direct", "ats").mapInArrow(read, "row long, gone long, kept string")


def substring_dedup(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, sha, kept) for each row of ``docs``: ``sha`` is the SHA-256 of the
    kept words joined by one space; ``kept`` is that string where words were removed, else null (the
    text's own words stand)."""
    keyed = shipped(docs).select(*doc_key(F.col(id_col), F.col(text_col)), F.col(text_col).cast("string").alias("text"))
    scanned = scratch(scan(keyed, width), "rep-symbols")
    rows = scanned.where("sha is not null").select("row", *KEY, "n", "sha")
    runs = scanned.where("name is not null").select("row", F.col("k_id").alias("doc_id"), "name", "u1", "u2", "first", "count")

    # whole copies: every window of a text stands in an earlier one
    holder = rows.where((F.col("n") >= width) & F.col("k_id").isNotNull()).groupBy("sha").agg(F.min("k_id").alias("holder"))
    rows = scratch(rows.join(holder, "sha", "left").withColumn(
        "copy", F.coalesce(F.col("holder") < F.col("k_id"), F.lit(False))).drop("holder"), "rep-rows")

    # equal runs: all windows of every later holder are repeats, no window needs a row
    equal = runs.groupBy("u1", "u2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("top"), F.min("name").alias("name"))
    equal = scratch(equal, "rep-equal")
    several = equal.groupBy("name").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("name", F.lit(True).alias("several"))
    # first holders of runs whose symbols head other runs too: their windows are compared one by one
    telling = equal.join(several, "name", "left").where("low < top or several").select(
        "u1", "u2", "low", F.coalesce("several", F.lit(False)).alias("several"))
    which = runs.drop("name").join(telling, ["u1", "u2"]).where("doc_id > low or several")
    which = which.select("row", "first", "count", (F.col("doc_id") > F.col("low")).alias("direct"))
    which = which.groupBy("row").agg(*[
        F.collect_list(F.when(F.col("direct") == on, F.struct("first", "count"))).alias(name)
        for name, on in (("direct", True), ("spans", False))])
    spans = scratch(rows.where("not copy").join(which, "row").dropDuplicates(KEY).select(*KEY, "row", "direct", "spans"), "rep-spans")
    texts = join_key(squeeze(keyed), spans, "inner").select("row", F.col("k_id").alias("doc_id"), "z", "direct", "spans")
    texts = scratch(texts.dropDuplicates(["row"]), "rep-texts")

    found = scratch(candidate_windows(texts.where(F.size("spans") > 0), width), "rep-windows")
    first = found.groupBy("w1", "w2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("top")).where("low < top")
    repeats = found.join(first, ["w1", "w2"]).where("doc_id > low").groupBy("row").agg(F.collect_list("at").alias("ats"))
    done = texts.join(repeats, "row", "left").where("size(direct) > 0 or ats is not null")
    done = cut(done, width)
    # rows that agree in id and text were cut once; all of them get the result
    done = join_key(rows.select("row", *KEY), spans.select(*KEY, F.col("row").alias("of")), "inner").join(
        done.withColumnRenamed("row", "of"), "of").select("row", "gone", "kept")
    out = rows.join(done, "row", "left")
    gone = F.when(F.col("copy"), F.col("n")).otherwise(F.coalesce("gone", F.lit(0)))
    kept = F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept"))
    return out.select(F.col("k_id").alias(id_col), F.col("n").alias("n_words"), gone.cast("long").alias("n_removed"),
                      F.coalesce(F.sha2(kept.cast("binary"), 256), F.lower(F.hex("sha"))).alias("sha"), kept.alias("kept"))
