"""MinHash near-duplicates by min-max hashing.

Each permutation yields two signature values, the smallest and the largest hash of the document's
shingle set, so a signature of 100 values takes 50 hash evaluations a shingle. The two agree with
probability J each and are nearly independent (slightly negatively correlated, which lowers the
variance of the estimate). Bands of four values (two permutations' minima and maxima), 25 of them,
miss a pair at similarity 0.8 with probability (1 - 0.8^4)^25 = 2e-6, less above.

Documents with equal sets are one class first, so exact copies never meet in pairs. Classes that
share a band are candidates, and a link needs its exact similarity on the full sets:

1. For every candidate, the shingles that no other candidate has are counted. Each bucket's hub is
   the member with the smallest share of them (the one closest to a common original), and every
   member is compared with its hub only.
2. The members of buckets that still hold several components are compared across components by
   prefixes: with shingles in one order, rare ones first, two sets of the wanted similarity share one
   among the first fifth of each (an exact bound, as are the size and place filters beside it). So
   documents that share a frequent passage, and bands by it, but are too different for a link do not
   meet in pairs. After that each candidate pair is compared, connected or ruled out, and the
   components are those of all candidate pairs.

Defined cases: null and empty texts have no shingles and no links, shorter texts one shingle; very long
texts are taken whole. Every row is a document of its own: rows that share an id but not the text are
linked only if their texts are alike, and each has its own component (the smallest id reachable from that
row); rows equal in id and text agree in everything. Rows without an id take no part (component null,
kept). An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import KEY, doc_key, scratch, shipped
from .graph import components, extended
from .hashing import U, WordHashes, constants, mix, split_words, windows

PERMUTATIONS = 50
PER_BAND = 2  # permutations; each gives two values
#: Pairs of one text that meet in one place.
PER_SALT = 256


def shingles(text: str | None, k: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit names of the text's ``k``-word shingles (A-Z lower-cased); a shorter
    text is one shingle of all its words."""
    h = words.of(split_words(text, lower=True))
    if not len(h):
        return h
    return np.unique(windows(h, k) if len(h) >= k else windows(h, len(h), seed=len(h) + 1))


def set_key(s: np.ndarray) -> bytes | None:
    """128-bit name of a shingle set."""
    return xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None


def min_max(s: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest hash of the set under each permutation, in slices of bounded size."""
    low = np.full(len(factors), ~U(0), dtype=U)
    high = np.zeros(len(factors), dtype=U)
    for i in range(0, len(s), 4096):
        x = s[i: i + 4096]
        x = (x ^ (x >> U(29)))[None, :] * factors[:, None]
        x ^= x >> U(32)
        np.minimum(low, x.min(axis=1), out=low)
        np.maximum(high, x.max(axis=1), out=high)
    return low, high


def bands(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One hash for each band of ``PER_BAND`` permutations' minima and maxima."""
    out = np.arange(1, len(low) // PER_BAND + 1, dtype=U)
    for values in (low, high):
        for k in range(PER_BAND):
            out = mix(out * U(0x9E3779B97F4A7C15) + values[k::PER_BAND])
    return out


def signatures(docs: DataFrame, k: int, id_col: str, text_col: str, permutations: int) -> DataFrame:
    """(k_id, k_h1, k_h2, n, set_key, bands) of each row; no set: n 0 and nulls."""
    factors = constants(permutations, 6)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for b in batches:
            n, keys, out = [], [], []
            for text in b.column("text").to_pylist():
                s = shingles(text, k, words)
                n.append(len(s))
                keys.append(set_key(s))
                out.append(bands(*min_max(s, factors)).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in KEY], pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(out, pa.list_(pa.int64()))],
                [*KEY, "n", "set_key", "bands"])

    d = shipped(docs).select(*doc_key(F.col(id_col), F.col(text_col)), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(sign, "k_id long, k_h1 long, k_h2 int, n long, set_key binary, bands array<long>")


def verify(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * |A & B| >= percent * |A | B|.

    ``a`` may stand in any number of pairs: its text goes out once for every ``PER_SALT`` of them."""
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last = WordHashes(), (None, None)
        for batch in batches:
            a, b, keep = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for i, (x, s, t) in enumerate(zip(a, batch.column(2), batch.column(3))):
                if last[0] != x:
                    last = (x, shingles(s.as_py(), k, words))
                p, q = last[1], shingles(t.as_py(), k, words)
                both = len(np.intersect1d(p, q, assume_unique=True))
                if both and 100 * both >= percent * (len(p) + len(q) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], ["a", "b"])

    t = texts.select(F.col("node"), F.col("text"))
    salts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PER_SALT).alias("salts"))
    salts = scratch(salts.where("salts > 1"), "near-hot")
    p = pairs.join(salts, "a", "left").withColumn("salt", F.pmod(F.xxhash64("b"), F.coalesce("salts", F.lit(1))))
    p = p.select("a", "b", "salt").join(t.withColumnsRenamed({"node": "b", "text": "tb"}), "b")
    hubs = t.withColumnsRenamed({"node": "a", "text": "ta"}).join(salts, "a", "left")
    hubs = hubs.select("a", "ta", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    p = p.join(hubs, ["a", "salt"]).select("a", "b", "ta", "tb")
    return scratch(p.mapInArrow(exact, "a long, b long"), "near-links")


def shingle_rows(texts: DataFrame, k: int) -> DataFrame:
    """(node, n, s): one row for each distinct shingle of each text, with the set's size."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for b in batches:
            s = [shingles(x, k, words) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) for x in s], pa.int64()),
                 pa.array([x.view(np.int64) for x in s], pa.list_(pa.int64()))], ["node", "n", "s"])

    d = texts.select("node", "text").mapInArrow(sets, "node long, n long, s array<long>")
    return d.select("node", "n", F.explode("s").alias("s"))


def own_shingles(texts: DataFrame, k: int) -> DataFrame:
    """(node, own): how many shingles a candidate set has that no other has (none: no row). One
    aggregation by shingle, combined on the map side."""
    seen = shingle_rows(texts, k).groupBy("s").agg(F.min("node").alias("low"), F.max("node").alias("top"))
    return seen.where("low = top").groupBy(F.col("low").alias("node")).agg(F.count(F.lit(1)).alias("own"))


def open_members(members: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """(node, part) of the members of buckets with several components (``part``: the component so
    far). Members whose set has too many shingles of its own for any link leave: no pair can share
    more than what is found elsewhere of either set."""
    m = members.join(label, "node", "left").select("band", "node", "n", "own", F.coalesce("component", "node").alias("part"))
    m = m.where(F.col("n") * percent <= (F.col("n") - F.col("own")) * 100)
    several = m.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("top")).where("low < top")
    m = m.join(several.select("band"), "band", "left_semi")
    return m.select("node", "part").distinct()


def prefix_pairs(open_docs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of ``open_docs`` from different components that can still have the similarity.

    A shingle's frequency and name give the order; ``place`` counts from 1 and includes the shingles
    found in one set only, which come first and never match. For each shingle the members of its most
    frequent component meet the others only, never each other."""
    each = scratch(shingle_rows(texts.join(open_docs, "node", "left_semi"), k), "near-open-shingles")
    often = each.groupBy("s").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    order = W.partitionBy("node")
    p = each.join(often, "s").join(open_docs, "node")
    p = p.withColumn("place", F.row_number().over(order.orderBy("c", "s")) + F.col("n") - F.count(F.lit(1)).over(order))
    p = p.where((F.col("n") - F.col("place") + 1) * 100 >= F.col("n") * percent)
    p = scratch(p.select("s", "node", "n", "part", "place"), "near-prefixes")
    by_part = p.groupBy("s", "part").agg(F.count(F.lit(1)).alias("c"))
    main = by_part.groupBy("s").agg(F.max_by("part", F.struct("c", "part")).alias("main"), F.count(F.lit(1)).alias("parts"))
    p = p.join(main.where("parts > 1").select("s", "main"), "s")
    rest = p.where("part <> main").select("s", F.col("node").alias("r"), F.col("part").alias("rp"), F.col("n").alias("rn"),
                                          F.col("place").alias("rplace"))
    most = F.least(F.col("n") - F.col("place"), F.col("rn") - F.col("rplace")) + 1
    pairs = rest.join(p, "s").where((F.col("rp") != F.col("part")) & (
        most * 100 >= (F.col("n") + F.col("rn") - most) * percent))
    return pairs.select(F.least("r", "node").alias("a"), F.greatest("r", "node").alias("b")).distinct()


def judged(docs: DataFrame, k: int, percent: int, permutations: int, id_col: str, text_col: str) -> DataFrame:
    """(k_id, k_h1, k_h2, n, component_id, stays) of each row; ``stays`` marks the row of each component that has
    the smallest id (of several, the smallest text hash), and rows that take no part. A *node* is one class of equal shingle sets: a number
    that no other class has, whatever ids its rows carry."""
    signed = scratch(signatures(docs, k, id_col, text_col, permutations), "near-signatures")
    classes = signed.where("n > 0 and k_id is not null").groupBy("set_key").agg(F.min(F.struct(*KEY)).alias("rep"))
    classes = scratch(classes.select("set_key", "rep.*", F.monotonically_increasing_id().alias("node")), "near-classes")
    rows = signed.select(*KEY, "n", "bands", "set_key").join(classes.select("set_key", "node", *[F.col(c).alias(f"r_{c}") for c in KEY]), "set_key")
    buckets = rows.where(" and ".join(f"{c} = r_{c}" for c in KEY)).dropDuplicates(["node"])  # rows equal in id and text
    buckets = buckets.select("node", "n", F.explode("bands").alias("band"))
    shared = buckets.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("top")).where("low < top")
    members = scratch(buckets.join(shared.select("band"), "band"), "near-buckets")
    # the texts that any candidate pair can need, moved once
    wanted = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", *KEY)
    texts = docs.select(*doc_key(F.col(id_col), F.col(text_col)), F.col(text_col).cast("string").alias("text"))
    texts = scratch(texts.join(wanted, KEY).dropDuplicates(["node"]).select("node", "text"), "near-texts")

    own = scratch(own_shingles(texts, k), "near-own")
    members = members.join(own, "node", "left").select("band", "node", "n", F.coalesce("own", F.lit(0)).alias("own"))
    hubs = members.groupBy("band").agg(F.min_by("node", F.struct(F.col("own") / F.col("n"), "node")).alias("hub"))
    members = scratch(members.join(hubs, "band"), "near-buckets")
    first = scratch(members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "near-pairs")
    label = components(verify(first, texts, k, percent))

    open_docs = scratch(open_members(members, label, percent), "near-open")
    if not open_docs.isEmpty():
        known = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = prefix_pairs(open_docs, texts, k, percent).join(known, ["a", "b"], "left_anti")
        label = extended(label, verify(scratch(pairs, "near-pairs"), texts, k, percent))

    parts = classes.join(label, "node", "left").select("set_key", F.struct(*KEY).alias("low"), F.coalesce("component", "node").alias("part"))
    lowest = parts.groupBy("part").agg(F.min("low").alias("first"))
    parts = parts.join(lowest, "part").select("set_key", "first")
    out = signed.join(parts, "set_key", "left")
    alone = F.col("k_id").isNull() | F.col("first").isNull()
    return out.select(*KEY, "n", F.when(F.col("k_id").isNotNull(), F.coalesce("first.k_id", "k_id")).alias("component_id"),
                      (alone | (F.col("first") == F.struct(*KEY))).alias("stays"))


def near_dups(docs: DataFrame, k: int = 5, percent: int = 80, permutations: int = PERMUTATIONS,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of ``docs``."""
    out = judged(docs, k, percent, permutations, id_col, text_col)
    kept = F.coalesce(F.col("k_id") == F.col("component_id"), F.lit(True))
    return out.select(F.col("k_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, permutations: int = PERMUTATIONS,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near copies: the one with the smallest id (of several with that
    id, the smallest text hash). Rows go by id and text, never by the id alone; of rows equal in both one stays,
    chosen by a hash of the whole row. Rows without an id or without words all stay."""
    rows = scratch(judged(docs, k, percent, permutations, id_col, text_col), "near-judged")
    gone = rows.where("not stays").select(*KEY).distinct().withColumn("twice", F.lit(False))
    twice = scratch(rows.where("stays and n > 0 and k_id is not null").groupBy(*KEY).agg(F.count(F.lit(1)).alias("c"))
                    .where("c > 1").select(*KEY, F.lit(True).alias("twice")), "near-equal-rows")
    whole = docs.select(F.struct("*").alias("row"), *doc_key(F.col(id_col), F.col(text_col)))
    whole = whole.join(gone.unionByName(twice), KEY, "left")
    rest = whole.where("twice is null").select("row.*")
    if twice.isEmpty():
        return rest
    order = W.partitionBy(*KEY).orderBy(F.xxhash64("row"))
    again = whole.where("twice").withColumn("nth", F.row_number().over(order)).where("nth = 1").select("row.*")
    return rest.unionByName(again)
