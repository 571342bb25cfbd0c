"""Nearest neighbours by shifted space-filling curves.

Several curves, each with a seeded projection to a few dimensions and a shift of its own, order the
vectors by Hilbert key. Each order is range-partitioned in Spark and cut into blocks; a query is
compared with the two neighbouring blocks in whose middle it lies, which are its key window. Windows
of all curves merge and the best are kept, by exact inner products in double precision.

How wide the windows must be is measured: a bounded sample of the queries is compared with the whole table,
and the blocks are doubled until the windows find the wanted share of their true neighbours. Blocks have a
largest size, which bounds a task; where the target is not met even then, or ``exact`` is asked for, a
sweep compares the queries with the rest of the table in blocks, leaving out a piece along the first
curve where its centre and radius prove that no inner product in it can count. Its result is exact.

Equal vectors are one entry (with the ``k + 1`` smallest ids, more can never be returned), so a
vector that a third of all rows share costs one place in an order and one search.

Defined cases: rows without an id, and vectors null, empty, zero, of another length than most, or with null or
non-finite components take no part; repeated rows count once; ties go to the smaller id; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import scratch
from .hilbert import hilbert_keys, to_cells

CURVES, DIMENSIONS, BITS = 16, 4, 8
BLOCK = 3072
#: Largest block, share of the true neighbours that the windows must find, and queries it is measured on.
MAX_BLOCK, RECALL, SAMPLE = 1 << 16, 0.95, 128
#: The sweep: entries that meet in one task from either side, and entries under one bound.
SIDE, PIECE = 4096, 256


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v, h1, h2): rows that take part, each (id, vector) once."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))
    v = v.withColumns({"h1": F.xxhash64("v"), "h2": F.hash("v")})
    size = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    v = v.where(F.size("v") == (size.d if size else 0))
    return v.dropDuplicates(["id", "h1", "h2"])


def classes(rows: DataFrame, k: int, is_query: Column) -> DataFrame:
    """(h1, h2, v, ids, asked): distinct vectors with their k + 1 smallest ids."""
    rank = F.row_number().over(W.partitionBy("h1", "h2").orderBy("id"))  # limited before the shuffle
    few = rows.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    ids = few.groupBy("h1", "h2").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    first = few.where("rank = 1").select("h1", "h2", "v")
    asked = rows.where(is_query).select("h1", "h2").distinct().withColumn("asked", F.lit(True))
    c = first.join(ids, ["h1", "h2"]).join(asked, ["h1", "h2"], "left")
    return c.withColumn("asked", F.coalesce("asked", F.lit(False)))


def ordered(entries: DataFrame, curves: int, seed: int) -> DataFrame:
    """(curve, place, h1, h2, v, asked): every entry's place along every curve."""
    d = entries.select(F.size("v")).first()
    if d is None:
        return entries.select(F.lit(0).alias("curve"), F.lit(0).cast("long").alias("place"), "h1", "h2", "v", "asked")
    d = d[0]
    rng = np.random.default_rng(seed)
    planes = rng.normal(size=(curves, d, DIMENSIONS)) / np.sqrt(d)
    shifts = rng.uniform(-0.25, 0.25, size=(curves, DIMENSIONS))
    # mean and spread of all rows, by component
    s = entries.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"), F.var_pop("x").alias("s"))
    s = {r.i: (r.m, r.s) for r in s.collect()}
    mean, var = np.array([s[i][0] for i in range(d)]), np.array([s[i][1] for i in range(d)])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.array(b.column(2).to_pylist(), dtype=float)
            for c in range(curves):
                spread = np.sqrt((planes[c] ** 2).T @ var)
                key = hilbert_keys(to_cells(x @ planes[c], mean @ planes[c], spread, BITS, shifts[c]), BITS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c] * len(key), pa.int32()), pa.array(key, pa.int64()), b.column(0), b.column(1)],
                    ["curve", "key", "h1", "h2"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            local = []
            for c in b.column(0).to_pylist():
                local.append(seen.get(c, 0))
                seen[c] = local[-1] + 1
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(local, pa.int64()), pa.array([part] * b.num_rows, pa.int32())],
                ["curve", "h1", "h2", "local", "part"])

    k = scratch(entries.select("h1", "h2", "v").mapInArrow(keyed, "curve int, key long, h1 long, h2 int"), "ann-keys")
    k = k.repartitionByRange("curve", "key", "h1", "h2").sortWithinPartitions("curve", "key", "h1", "h2")
    k = scratch(k.select("curve", "h1", "h2").mapInArrow(counted, "curve int, h1 long, h2 int, local long, part int"), "ann-order")
    totals = k.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("curve").orderBy("part")) - F.col("n")  # a row for each partition
    k = k.join(F.broadcast(totals.select("curve", "part", before.alias("before"))), ["curve", "part"])
    k = k.select("curve", (F.col("local") + F.col("before")).alias("place"), "h1", "h2")
    return k.join(entries.select("h1", "h2", "v", "asked"), ["h1", "h2"])


def search(o: DataFrame, k: int, block: int) -> DataFrame:
    """(q1, q2, h1, h2, score): for each asked entry the k + 1 best entries of each of its windows."""
    half = F.col("place") % block < block // 2
    b = F.floor(F.col("place") / block)
    # group g holds blocks g and g + 1; a query asks the group in whose middle it lies
    home = F.when(half & (b > 0), b - 1).otherwise(b)
    o = o.withColumn("g", F.explode(F.array(b - 1, b))).where("g >= 0").withColumn("mine", F.col("asked") & (F.col("g") == home))

    def best(group: pd.DataFrame) -> pd.DataFrame:
        """At most 2 * block rows, whatever the table's size."""
        q = group[group["mine"]]
        out = {"q1": [], "q2": [], "h1": [], "h2": [], "score": []}
        if len(q):
            x, h1, h2 = np.stack(group["v"]), group["h1"].to_numpy(), group["h2"].to_numpy()
            keep = min(k + 1, len(x))
            for at in range(0, len(q), 256):
                part = q.iloc[at: at + 256]
                s = np.stack(part["v"]) @ x.T
                top = np.argpartition(-s, keep - 1, axis=1)[:, :keep]
                out["q1"].append(np.repeat(part["h1"].to_numpy(), keep))
                out["q2"].append(np.repeat(part["h2"].to_numpy(), keep))
                out["h1"].append(h1[top].ravel())
                out["h2"].append(h2[top].ravel())
                out["score"].append(np.take_along_axis(s, top, axis=1).ravel())
        return pd.DataFrame({c: np.concatenate(a) if a else [] for c, a in out.items()})

    return o.select("curve", "g", "h1", "h2", "v", "mine").groupBy("curve", "g").applyInPandas(
        best, "q1 long, q2 int, h1 long, h2 int, score double")


def best_rows(found: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """(q1, q2, near): of the pairs found, the k + 1 best rows of each asked vector, in order."""
    found = found.groupBy("q1", "q2", "h1", "h2").agg(F.max("score").alias("score"))
    first = F.row_number().over(W.partitionBy("q1", "q2").orderBy(F.desc("score"), F.get("ids", F.lit(0))))
    found = found.join(entries.select("h1", "h2", "ids"), ["h1", "h2"]).withColumn("r", first).where(F.col("r") <= k + 1)
    # of the best entries, the best rows: one list of at most k + 1 for each asked vector
    found = found.select("q1", "q2", "score", F.explode("ids").alias("id"))
    first = F.row_number().over(W.partitionBy("q1", "q2").orderBy(F.desc("score"), "id"))
    found = found.withColumn("r", first).where(F.col("r") <= k + 1)
    return found.groupBy("q1", "q2").agg(F.array_sort(F.collect_list(F.struct("r", "id", "score"))).alias("near"))


def true_neighbours(entries: DataFrame, sample: list, k: int) -> DataFrame:
    """(q1, q2, h1, h2, score): the k + 1 best entries of each sampled vector, by one pass over all entries."""
    w = np.array([r.v for r in sample])
    q1, q2 = np.array([r.h1 for r in sample]), np.array([r.h2 for r in sample])

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Holds k + 1 entries for each of at most SAMPLE vectors between batches."""
        s, h1, h2 = np.empty((len(w), 0)), np.empty((len(w), 0), np.int64), np.empty((len(w), 0), np.int32)
        for b in batches:
            if len(b):
                s = np.hstack([s, w @ np.stack(b["v"]).T])
                h1 = np.hstack([h1, np.broadcast_to(b["h1"].to_numpy(), (len(w), len(b)))])
                h2 = np.hstack([h2, np.broadcast_to(b["h2"].to_numpy(), (len(w), len(b)))])
                top = np.argpartition(-s, min(k + 1, s.shape[1]) - 1, axis=1)[:, : k + 1]
                s, h1, h2 = (np.take_along_axis(x, top, axis=1) for x in (s, h1, h2))
        n = s.shape[1]
        yield pd.DataFrame({"q1": np.repeat(q1, n), "q2": np.repeat(q2, n).astype(np.int32), "h1": h1.ravel(),
                            "h2": h2.ravel(), "score": s.ravel()})

    return entries.select("h1", "h2", "v").mapInPandas(best, "q1 long, q2 int, h1 long, h2 int, score double")


def recall(near: DataFrame, truth: dict[tuple, set], sample: DataFrame) -> float:
    """Share of the true neighbours (by vector) that ``near`` holds for the sampled ones."""
    got = near.join(sample, ["q1", "q2"], "left_semi").collect()  # at most SAMPLE short lists
    hits = sum(len(truth[r.q1, r.q2] & {x.id for x in r.near}) for r in got)
    return hits / max(sum(map(len, truth.values())), 1)


def windows(o: DataFrame, entries: DataFrame, k: int, block: int, target: float, most: int) -> tuple[DataFrame, float, int]:
    """(pairs found, recall on the sample, block): windows doubled until they meet the target or their bound."""
    sample = entries.where("asked").orderBy("h1", "h2").limit(SAMPLE).select("h1", "h2", "v").collect()
    n = entries.count()
    if not sample:
        return search(o, k, block), 1.0, block
    # (in exact terms a tie beyond the last place is as good as the one before it; ids decide it in both)
    exact = best_rows(true_neighbours(entries, sample, k), entries, k)
    truth = {(r.q1, r.q2): {x.id for x in r.near} for r in exact.collect()}
    few = entries.sparkSession.createDataFrame([(r.h1, r.h2) for r in sample], "q1 long, q2 int")
    while True:
        found = scratch(search(o, k, block), "ann-windows")
        share = recall(best_rows(found, entries, k), truth, few)
        if share >= target or block >= most or block >= n:
            return found, share, block
        block *= 2


def sweep(line: DataFrame, near: DataFrame, entries: DataFrame, k: int, side: int) -> DataFrame:
    """(q1, q2, h1, h2, score): every entry whose score reaches the last of an asked entry's ``near``, at
    most k + 1 for each ``side`` entries of ``line`` (place, h1, h2, v, asked). Pieces are left out by proof only."""
    least = F.when(F.size("near") > k, F.element_at("near", -1)["score"]).otherwise(float("-inf"))
    line = line.withColumn("side", F.floor(F.col("place") / side))
    counts = line.groupBy("side").agg(F.count_if("asked").alias("n"))  # a row for each side
    before = F.sum("n").over(W.orderBy("side")) - F.col("n")
    groups = scratch(counts.select("side", F.floor(before / side).alias("g")), "ann-groups")
    n_sides, n_groups = groups.agg(F.coalesce(F.max("side") + 1, F.lit(0)), F.coalesce(F.max("g") + 1, F.lit(0))).first()
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(max(n, 1) - 1)).cast("array<long>"))
    asked = line.where("asked").join(near.select(F.col("q1").alias("h1"), F.col("q2").alias("h2"), least.alias("least")),
                                     ["h1", "h2"], "left").join(groups, "side")
    asked = asked.select("g", "h1", "h2", "v", F.coalesce("least", F.lit(float("-inf"))).alias("least"))
    asked = asked.select("*", every(n_sides).alias("side")).toDF("g", "h1", "h2", "v", "least", "side")  # new names for the cogroup
    held = line.join(entries.select("h1", "h2", F.get("ids", F.lit(0)).alias("id")), ["h1", "h2"])
    held = held.select("side", "place", "h1", "h2", "v", "id", every(n_groups).alias("g"))

    def reach(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        """At most 2 * side queries and side entries, whatever the table's size."""
        out = {"q1": [], "q2": [], "h1": [], "h2": [], "score": []}
        if len(q) and len(x):
            x = x.sort_values("place")
            v, h1, h2, id_ = np.stack(x["v"]), x["h1"].to_numpy(), x["h2"].to_numpy(), x["id"].to_numpy()
            for at in range(0, len(q), 1024):
                part = q.iloc[at: at + 1024]
                w, q1, q2 = np.stack(part["v"]), part["h1"].to_numpy(), part["h2"].to_numpy()
                norm = np.linalg.norm(w, axis=1)
                # sums of another order differ in the last places
                least = part["least"].to_numpy() - 1e-9 * norm * np.linalg.norm(v, axis=1).max()

                def first_of(i: np.ndarray, j: np.ndarray, score: np.ndarray) -> tuple:
                    """The k + 1 best of each query, ties to the smaller id."""
                    by = np.lexsort((id_[j], -score, i))
                    i, j, score = i[by], j[by], score[by]
                    few = np.arange(len(i)) - np.searchsorted(i, i) <= k
                    return i[few], j[few], score[few]

                hits = []
                for p in range(0, len(v), PIECE):
                    piece = v[p: p + PIECE]
                    centre = piece.mean(axis=0)
                    radius = np.linalg.norm(piece - centre, axis=1).max()
                    open_ = np.flatnonzero(w @ centre + norm * radius >= least)
                    score = w[open_] @ piece.T
                    i, j = np.nonzero(score >= least[open_, None])
                    hits.append((open_[i], p + j, score[i, j]))
                    if sum(len(z[0]) for z in hits) > 64 * PIECE * (k + 1):  # a low bound lets much through
                        hits = [first_of(*(np.concatenate(y) for y in zip(*hits)))]
                i, j, score = first_of(*(np.concatenate(y) for y in zip(*hits)))
                for c, a in zip(out, (q1[i], q2[i], h1[j], h2[j], score)):
                    out[c].append(a)
        return pd.DataFrame({c: np.concatenate(a) if a else [] for c, a in out.items()})

    return asked.groupBy("g", "side").cogroup(held.groupBy("g", "side")).applyInPandas(
        reach, "q1 long, q2 int, h1 long, h2 int, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, curves: int = CURVES, block: int = BLOCK, seed: int = 5,
            id_col: str = "vec_id", vec_col: str = "embedding", side: int = SIDE, target: float = RECALL,
            most: int = MAX_BLOCK, exact: bool = False) -> DataFrame:
    """(query_id, rank, id, score) of the ``k`` nearest; ``is_query`` is over the column ``id``. The windows find at
    least ``target`` of the sampled queries' neighbours, or the sweep is added, as it is with ``exact``."""
    rows = scratch(usable(vectors, id_col, vec_col), "ann-rows")
    entries = scratch(classes(rows, k, is_query), "ann-entries")
    o = scratch(ordered(entries, curves, seed), "ann-places")
    found, share, _ = windows(o, entries, k, block, target, most)
    if exact or share < target:
        line = o.where("curve = 0").drop("curve")
        found = found.unionByName(sweep(line, best_rows(found, entries, k), entries, k, side))
    found = best_rows(found, entries, k)
    q = rows.where(is_query).select("id", F.col("h1").alias("q1"), F.col("h2").alias("q2")).join(found, ["q1", "q2"])
    near = F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k)
    q = q.select(F.col("id").alias("query_id"), F.posexplode(near).alias("at", "x"))
    return q.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias(id_col), F.col("x.score").alias("score"))
