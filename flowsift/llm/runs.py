"""Periodic runs of words by an enhanced suffix array's branching-tandem test.

A run is a stretch of consecutive words of least period q (words q apart are equal), at least
``max(shortest, 2 q)`` long, that no neighbouring word extends. Spark deals the texts out; a task sorts
the suffixes of a block of texts at once. Words are numbered apart in each text and every text ends in a
mark of its own, so no common prefix crosses texts. Each LCP interval of depth d is split where its
least value stands; of the two sides the smaller one's suffixes i are tested: if the suffix i + d (or
i - d) lies on the other side, by the inverse suffix array, then words i .. i + 2d (or i - d .. i + d)
are a square that the next word breaks. Every run ends in exactly one such square of its period. A
square whose period is a multiple of another's that ends in the same place and covers it is not of
least period and goes; the others are rotated to the left while the words agree, which gives their
run's start. Only ``O(n log n)`` tests are made, no tree node is built, and a text of one repeated word
or of a million words costs no more than others of its length.

Defined cases: null, empty and blank texts have no words and no runs; a null id is returned as null;
repeated rows are each judged by themselves; very long texts are handled whole, in a block of their
own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shipped

#: Words of a block of texts (a longer text is a block of its own).
BLOCK_WORDS = 200_000
#: Suffixes tested at once.
TESTED = 1 << 20


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(suffix array, inverse, ranks by the first 1, 2, 4, ... symbols); the last symbol must be unique.

    Prefix doubling; a round sorts only the suffixes that are not yet told apart."""
    n = len(symbols)
    sa = np.argsort(symbols, kind="stable")
    key, slots, placed = symbols[sa], np.arange(n), sa
    rank = np.empty(n, dtype=np.int64)
    ranks, size = [], 1
    while True:
        first = np.append(True, key[1:] != key[:-1])
        head = np.flatnonzero(first)
        count = np.diff(np.append(head, len(key)))
        rank[placed] = np.repeat(slots[head], count)
        ranks.append(rank.astype(np.int32))
        same = np.repeat(count > 1, count)
        if not same.any():
            return sa, rank, ranks
        slots, placed = slots[same], placed[same]
        key = rank[placed] * n + rank[placed + size]
        order = np.argsort(key, kind="stable")
        placed, key = placed[order], key[order]
        sa[slots] = placed
        size *= 2


def common_prefixes(sa: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Length of the prefix that each suffix shares with the one before it in the array (first: 0)."""
    out = np.zeros(len(sa), dtype=np.int64)
    at = np.flatnonzero(ranks[0][sa[1:]] == ranks[0][sa[:-1]]) + 1
    a, b = sa[at - 1], sa[at]
    shared = np.zeros(len(at), dtype=np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        step = np.where(ranks[level][a] == ranks[level][b], 1 << level, 0)
        shared += step
        a, b = a + step, b + step
    out[at] = shared
    return out


def sides(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(at, low, high): for each place with a common prefix, the suffixes low .. at - 1 and at .. high - 1 are the
    two sides of its part of the LCP interval (equal depths are split from the right)."""
    at = np.flatnonzero(lcp)
    low, high = [], [0] * len(at)
    stack: list[int] = []  # places in `at`, of increasing depth
    places, depths = at.tolist(), lcp[at].tolist()
    previous = -2
    for i, (place, depth) in enumerate(zip(places, depths)):
        if place != previous + 1:  # no common prefix in between
            for s in stack:
                high[s] = previous + 1
            stack.clear()
            base = place - 1
        while stack and depths[stack[-1]] >= depth:
            high[stack.pop()] = place
        low.append(places[stack[-1]] if stack else base)
        stack.append(i)
        previous = place
    for s in stack:
        high[s] = previous + 1
    return at, np.array(low, dtype=np.int64), np.array(high, dtype=np.int64)


def branching_squares(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every square that the word after it breaks."""
    at, low, high = sides(lcp)
    left = at - low <= high - at
    size = np.minimum(at - low, high - at)
    ends = np.cumsum(size)
    starts, periods = [], []
    cut = 0
    while cut < len(at):
        until = max(int(np.searchsorted(ends, (ends[cut - 1] if cut else 0) + TESTED, side="right")), cut + 1)
        part = slice(cut, until)
        s = size[part]
        offset = np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
        i = sa[np.repeat(np.where(left[part], low[part], at[part]), s) + offset]
        d = np.repeat(lcp[at[part]], s)
        other = [np.repeat(np.where(left[part], a[part], b[part]), s) for a, b in ((at, low), (high, at))]
        there = isa[i + d]
        ok = (there >= other[0]) & (there < other[1])
        starts.append(i[ok])
        periods.append(d[ok])
        back = i - d
        there = isa[np.maximum(back, 0)]
        ok = (back >= 0) & (there >= other[0]) & (there < other[1])
        starts.append(back[ok])
        periods.append(d[ok])
        cut = until
    empty = [np.empty(0, dtype=np.int64)]
    return np.concatenate(starts or empty), np.concatenate(periods or empty)


def rotated(symbols: np.ndarray, start: int, period: int) -> int:
    """How far a square can be rotated to the left: agreeing symbols before it and before its second half."""
    done, step = 0, 16
    while done < start:
        k = min(step, start - done)
        a = symbols[start - done - k: start - done]
        differ = np.flatnonzero(a != symbols[start - done - k + period: start - done + period])
        if len(differ):
            return done + k - 1 - int(differ[-1])
        done += k
        step *= 2
    return done


def runs_of(symbols: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period; the last symbol must be unique."""
    sa, isa, ranks = suffix_array(symbols)
    starts, periods = branching_squares(sa, isa, common_prefixes(sa, ranks))
    ends = starts + 2 * periods
    order = np.lexsort((periods, ends))
    out: list[tuple[int, int, int]] = []
    here, known = -1, []
    for i, d, e in zip(starts[order].tolist(), periods[order].tolist(), ends[order].tolist()):
        if e != here:
            here, known = e, []
        elif any(d % q == 0 and s <= i for s, q in known):
            continue  # a power of a shorter word: the run of that word ends here too
        s = i - rotated(symbols, i, d)
        known.append((s, d))
        if e - s >= shortest:
            out.append((s, e - s, d))
    return sorted((s, n, d) for s, n, d in out)


def _block(texts: list[list[bytes]], shortest: int) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """Runs of each text, and each text's words without the repetitions, joined by one space."""
    number: dict[bytes, int] = {}
    for words in texts:
        for w in words:
            number.setdefault(w, len(number))
    width = len(number) + 1
    parts, offsets, at = [], [], 0
    for k, words in enumerate(texts):
        ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
        parts += [ids + k * width, np.array([k * width + width - 1])]
        offsets.append(at)
        at += len(words) + 1
    found = runs_of(np.concatenate(parts), shortest)
    edge = np.zeros(at + 1, dtype=np.int64)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    owners = np.searchsorted(offsets, [s for s, _, _ in found], side="right") - 1
    for (s, n, d), k in zip(found, owners.tolist()):
        runs[k].append((s - offsets[k], n, d))
        edge[s + d] += 1
        edge[s + n] -= 1
    gone = np.cumsum(edge) > 0
    kept = []
    for k, words in enumerate(texts):
        if runs[k]:
            stay = np.flatnonzero(~gone[offsets[k]: offsets[k] + len(words)])
            words = [words[i] for i in stay.tolist()]
        kept.append(b" ".join(words))
    return runs, kept


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(docs: DataFrame, shortest: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each text: (doc_id, n_words, runs, collapsed). ``runs`` holds (start, length, period) by start,
    then period; ``collapsed`` the text's words joined by one space, without those that a run repeats after its
    first period."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts: list[list[bytes]] = []
            at, held = 0, 0

            def done(at: int, texts: list[list[bytes]]) -> pa.RecordBatch:
                runs, kept = _block(texts, shortest)
                rows = [[{"start": s, "length": n, "period": d} for s, n, d in r] for r in runs]
                return pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array(rows, pa.list_(RUN)), pa.array(kept, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])

            for k in range(b.num_rows):
                words = (b.column(1)[k].as_py() or b"").split()  # cuts at exactly the six separators
                if texts and held + len(words) > BLOCK_WORDS:
                    yield done(at, texts)
                    at, held, texts = k, 0, []
                texts.append(words)
                held += len(words)
            if texts:
                yield done(at, texts)

    d = shipped(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    out = d.mapInArrow(found, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))
