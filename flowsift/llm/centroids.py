"""Centroid clustering: Lloyd rounds on integer vectors, pruned by a stored table of pivot distances (LAESA).

Vectors become integers, so every sum, mean and squared distance is exact and the result does not
depend on partitions. A few fixed pivots are taken from the starting centroids (farthest first), and
each vector's distances to them are computed once and written beside it. In a round, the greatest
difference between a vector's and a centroid's pivot distances is a lower bound of their distance
(triangle inequality). The centroid of least bound gets its exact integer distance first; of the
others only those whose bound does not exceed the best distance so far get theirs. Bounds are floating
point and are lowered by more than their rounding error, so no centroid is left out wrongly.

Each round is one pass over the written table. A task hands on one partial row for each centroid
(count and component sums), Spark adds them up, and the driver gets at most ``k`` rows.

Defined cases: vectors that are null, of another length, or hold a null or non-finite component take no
part and give no row; a row without an id takes part and is a start only where ids do not suffice; rows
of equal id are separate vectors (as starts ordered by their components); with fewer than ``k`` vectors
each is a start; an empty table gives an empty result. Components beyond 2**26 after scaling raise an
error: their distances would not fit a long. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, shipped

#: Largest absolute component: squared distances of up to 128 components stay below 2**63.
LARGEST = 1 << 26
#: Relative slack of the floating-point bounds (double rounding is below 1e-15).
SLACK = 1e-12
#: Vectors compared at once.
BLOCK = 4096


def quantised(vectors: DataFrame, length: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): components floor(scale * x) of the vectors that take part."""
    x = F.col("x")
    inf = float("inf")
    fit = (F.size(x) == length) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != inf))
    whole = F.transform(x, lambda e: F.floor(e * scale))
    small = F.forall("v", lambda e: F.abs(e) <= LARGEST)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x"))
    rows = rows.where(F.coalesce(fit, F.lit(False))).select("vec_id", whole.alias("v"))
    return rows.select("vec_id", F.when(small, F.col("v")).otherwise(
        F.raise_error(F.lit(f"a component exceeds {LARGEST} after scaling"))).cast("array<int>").alias("v"))


def starts(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors of smallest sha256 of ``seed:id``."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = rows.orderBy(order.asc_nulls_last(), "v").limit(k).collect()
    return np.array([r.v for r in first], dtype=np.int64)


def far_apart(points: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the points, each farthest from those chosen before."""
    chosen = [0]
    left = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(points)) and left.max() > 0:
        chosen.append(int(left.argmax()))
        left = np.minimum(left, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of each point to each pivot."""
    return np.stack([np.sqrt(((points - p) ** 2).sum(axis=1).astype(float)) for p in pivots], axis=1)


def nearest(v: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of each vector, and how many exact distances that took."""
    c = distances(centroids, pivots)
    bound = np.zeros((len(v), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - c[None, :, p]), out=bound)
    slack = SLACK * (to_pivots.max(axis=1, keepdims=True) + c.max())
    bound = np.square(np.maximum(bound - slack, 0.0)) * (1 - SLACK)
    who = bound.argmin(axis=1)
    best = ((v - centroids[who]) ** 2).sum(axis=1)
    guess, exact = who.copy(), len(v)
    for k in range(len(centroids)):
        rows = np.flatnonzero((bound[:, k] <= best) & (guess != k))
        d = ((v[rows] - centroids[k]) ** 2).sum(axis=1)
        better = (d < best[rows]) | ((d == best[rows]) & (k < who[rows]))
        best[rows[better]], who[rows[better]] = d[better], k
        exact += len(rows)
    return who, best, exact


def _matrix(column: pa.Array, rows: int, dtype: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(rows, -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            b = batch.slice(at, BLOCK)
            yield b, _matrix(b.column("v"), b.num_rows, np.int64), _matrix(b.column("to_pivots"), b.num_rows, float)


def pivot_table(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, v, to_pivots), written once."""
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d = distances(_matrix(b.column("v"), b.num_rows, np.int64), pivots)
                ends = pa.array(np.arange(0, d.size + 1, d.shape[1]), pa.int32())
                yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(ends, pa.array(d.ravel()))],
                                                 ["vec_id", "v", "to_pivots"])

    return scratch(shipped(rows).mapInArrow(measured, "vec_id long, v array<int>, to_pivots array<double>"), "pivot-distances")


def moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, int]:
    """The centroids after one round, and the exact distances it took."""
    length = centroids.shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, exact = np.zeros(len(centroids), dtype=np.int64), 0
        sums = np.zeros_like(centroids)
        for _, v, d in _blocks(batches):
            who, _, tested = nearest(v, d, centroids, pivots)
            n += np.bincount(who, minlength=len(centroids))
            np.add.at(sums, who, v)
            exact += tested
        if n.any():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(n[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64())),
                 pa.array([exact] + [0] * (len(some) - 1), pa.int64())], ["cluster", "n", "sums", "exact"])

    parts = table.mapInArrow(partial, "cluster int, n long, sums array<long>, exact long")
    got = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("exact").alias("exact"),
                                       F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(length)]).alias("sums")).collect()
    new = centroids.copy()
    for r in got:  # at most one row for each centroid
        new[r.cluster] = [s // r.n for s in r.sums]
    return new, sum(r.exact for r in got)


def assigned(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, v, d in _blocks(batches):
            who, best, _ = nearest(v, d, centroids, pivots)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(who, pa.int32()), pa.array(best, pa.int64())],
                                             ["vec_id", "cluster", "distance"])

    return scratch(table.mapInArrow(rows, "vec_id long, cluster int, distance long"), "clusters")


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, pivots: int = 16, scale: int = 256, length: int = 64,
            seed: int = 2, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row for each vector that takes part: (vec_id, cluster, distance, cluster_inertia, inertia,
    centroid); ``centroid`` holds the final centroid's integer components."""
    spark = vectors.sparkSession
    rows = quantised(vectors, length, scale, id_col, vec_col)
    centroids = starts(rows, k, seed)
    if not len(centroids):
        return rows.limit(0).select("vec_id", F.lit(0).alias("cluster"), *[
            F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.col("v").alias("centroid"))
    fixed = far_apart(centroids, pivots)
    table = pivot_table(rows, fixed)
    for _ in range(rounds):
        centroids, _ = moved(table, centroids, fixed)
    found = assigned(table, centroids, fixed)
    sums = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    total = sum(sums.values())
    each = spark.createDataFrame([(i, c.tolist(), sums.get(i, 0), total) for i, c in enumerate(centroids)],
                                 "cluster int, centroid array<int>, cluster_inertia long, inertia long")  # k rows
    return found.join(F.broadcast(each), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")

