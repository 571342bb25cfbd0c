"""Secret scan: stated patterns, and a randomness test battery for everything else.

Beside three patterns (assignments, access keys, long hex), every token of 20 or more characters
of a base64-like alphabet is a candidate ('=' is padding and ends it, so a name before '=' is no part
of it). A token that no listed alphabet holds mixes '+' or '/' with '-' or '_': its parts between the
one pair and its parts between the other are candidates instead. Its encoding is the smallest listed alphabet that holds
all its characters. Three tests ask whether the token can be uniformly random in that alphabet:
chi-squared over the alphabet, Wald-Wolfowitz runs about the alphabet's middle, and lag-1 serial
correlation. A token that fails none of them is weighed against ordinary text: e = the likelihood
ratio of uniform characters over the corpus's own character frequencies (counted over all texts, tokens
that are candidates themselves left out, so that random tokens do not make random text look ordinary).
E-values grow with the token's length by themselves; discoveries are controlled at ``fdr`` for each
length class by the e-value form of the Benjamini-Hochberg step (reject the k largest when the k-th
is at least m / (fdr k)), which holds under any dependence. The step needs only a histogram of
log e, which Spark sums; its size is fixed.

Defined cases: a null or empty text holds nothing; repeated rows are each scanned; very long texts and
texts of very many tokens take time in proportion to their length; a null id is returned as null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, shipped

# The contract's patterns, kinds in listed order.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the runs of [0-9a-f]+ that have 32 characters
MARKS = ("password", "passwd", "secret", "token", "apikey", "api_key")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
#: Parts of a token that mixes the separators of both base64 forms.
PARTS = (re.compile(r"[A-Za-z0-9+/]{20,}"), re.compile(r"[A-Za-z0-9_-]{20,}"))
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = (DIGITS + LOWER[:6], DIGITS + UPPER[:6], LOWER, UPPER, UPPER + "234567", DIGITS + LOWER, DIGITS + UPPER,
             UPPER + LOWER, UPPER + LOWER + DIGITS, UPPER + LOWER + DIGITS + "+/", UPPER + LOWER + DIGITS + "-_")
#: Upper ends of the length classes.
LENGTHS = (32, 64)
#: Log e-values are counted in eighths up to this many.
BINS = 1024
MIN_P = 0.001
FDR = 1e-4


def encoding(token: str) -> str | None:
    """Smallest listed alphabet with all characters of the token."""
    chars = set(token)
    return next((a for a in sorted(ALPHABETS, key=len) if chars <= set(a)), None) if chars else None


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(token: str, alphabet: str) -> tuple[float, float, float]:
    """p-values of the uniformity, runs and serial-correlation tests; 1 where a test is undefined."""
    place = {c: i for i, c in enumerate(alphabet)}
    x = np.array([place[c] for c in token], dtype=float)
    n, k = len(x), len(alphabet)
    chi = float(((np.bincount(x.astype(int), minlength=k) - n / k) ** 2).sum() * k / n)
    spread = 2 * (k - 1) * (n - 1) / n  # exact variance of the statistic
    p_chi = 0.5 * math.erfc((chi - (k - 1)) / math.sqrt(2 * spread)) if spread > 0 else 1.0
    high = x >= k / 2
    a, b = int(high.sum()), int((~high).sum())
    p_runs = 1.0
    if a and b:
        mean = 2 * a * b / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = _two_sided((int((high[1:] != high[:-1]).sum()) + 1 - mean) / math.sqrt(var)) if var > 0 else 1.0
    elif n > 20:
        p_runs = 2.0 ** (1 - n)
    sx = float(x.std())
    p_serial = 1.0
    if sx > 0:
        r = float(((x[1:] - x.mean()) * (x[:-1] - x.mean())).mean()) / sx ** 2
        p_serial = _two_sided((r + 1 / n) * math.sqrt(n))
    return p_chi, p_runs, p_serial


def log_e(token: str, alphabet: str, counts: list[int]) -> float:
    """Log likelihood ratio of uniform characters over the corpus's frequencies in that alphabet."""
    freq = {c: counts[ord(c)] + 1 for c in alphabet}
    total = sum(freq.values())
    return sum(math.log(total / (len(alphabet) * freq[c])) for c in token)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the stated patterns, sorted."""
    out = []
    low = text.lower()
    if any(m in low for m in MARKS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, counts: list[int]) -> list[tuple[int, int, int, int, bool]]:
    """(start, end, length class, eighths of log e, passes the battery) of each candidate token."""
    spans: dict[tuple[int, int], str] = {}
    for m in CANDIDATE.finditer(text):
        if encoding(m[0]) is not None:
            spans[m.span()] = m[0]
        else:
            spans.update((x.span(), x[0]) for part in PARTS for x in part.finditer(text, *m.span()))
    out = []
    for (start, stop), token in sorted(spans.items()):
        alphabet = encoding(token)
        length = sum(len(token) > x for x in LENGTHS)
        e = min(BINS, max(0, int(8 * log_e(token, alphabet, counts))))
        out.append((start, stop, length, e, min(battery(token, alphabet)) >= MIN_P))
    return out


def character_counts(docs: DataFrame, text_col: str) -> list[int]:
    """How often each ASCII character stands in the corpus outside candidate tokens: one row of 128 sums for
    each partition, then one aggregation; 128 numbers reach the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, dtype=np.int64)
        for b in batches:
            data = CANDIDATE.sub("", "\n".join(x for x in b.column(0).to_pylist() if x)).encode("utf-8", "replace")
            total += np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
        yield pa.RecordBatch.from_pydict({"c": pa.array(range(128), pa.int32()), "n": pa.array(total[:128], pa.int64())})

    got = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "c int, n long").groupBy("c").agg(F.sum("n").alias("n"))
    found = {r.c: r.n for r in got.collect()}
    return [found.get(i, 0) for i in range(128)]


SCANNED = ("doc_id long, base array<struct<start:long,kind:int,stop:long>>, "
           "tokens array<struct<start:long,stop:long,length:int,e:int,random:boolean>>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """(id, base, found): arrays of spans (start, kind, stop) in code points, end exclusive; ``base``
    by the patterns, ``found`` the tokens that the battery adds. One row for each row of ``docs``."""
    counts = character_counts(shipped(docs), text_col)
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64())]))
    token = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("length", pa.int32()), ("e", pa.int32()), ("random", pa.bool_())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, tokens = [], []
            for text in b.column(1).to_pylist():
                text = text or ""
                base.append([dict(zip(("start", "kind", "stop"), x)) for x in base_spans(text)])
                tokens.append([dict(zip(("start", "stop", "length", "e", "random"), x)) for x in candidates(text, counts)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(base, span), pa.array(tokens, token)], ["doc_id", "base", "tokens"])

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    d = scratch(d.mapInArrow(read, SCANNED), "secret-spans")
    limits = thresholds(d.select(F.inline("tokens")), fdr)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[{"start": s, "kind": 3, "stop": e} for s, e in outermost(
                [(t["start"], t["stop"]) for t in tokens if t["random"] and t["e"] >= limits.get(t["length"], BINS + 1)])]
                for tokens in b.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("base"), pa.array(found, span)], ["doc_id", "base", "found"])

    spans = "array<struct<start:long,kind:int,stop:long>>"
    return d.mapInArrow(decide, f"doc_id long, base {spans}, found {spans}").withColumnRenamed("doc_id", id_col)


def outermost(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of spans that lie one in the other, the outer ones, in order: one pass over the sorted spans."""
    out, reach = [], -1
    for start, stop in sorted(spans, key=lambda x: (x[0], -x[1])):
        if stop > reach:
            out.append((start, stop))
            reach = stop
    return out


def thresholds(tokens: DataFrame, fdr: float) -> dict[int, int]:
    """Smallest log e (in eighths) that the e-value step accepts, by length class. The histogram has
    at most BINS + 1 rows for each of three classes."""
    rows = tokens.groupBy("length", "e").agg(
        F.count(F.lit(1)).alias("m"), F.sum(F.col("random").cast("long")).alias("n")).collect()
    out = {}
    for k in {r.length for r in rows}:
        own = {r.e: (r.m, r.n) for r in rows if r.length == k}
        m, above = sum(x for x, _ in own.values()), 0
        for e in range(BINS, -1, -1):
            above += own.get(e, (0, 0))[1]
            if above and e / 8 >= math.log(m / (fdr * above)):
                out[k] = e
    return out
