"""Centroid clustering against all distances, and the defined cases."""

import hashlib
import random

import duckdb
import numpy as np

from flowsift.llm import centroids
from flowsift.llm.queries import QUERIES
from flowsift.llm.sql import ORACLE

SCHEMA = "vec_id long, embedding array<float>, cluster string, v string"


def brute(vectors: dict[int, list[float]], k: int, rounds: int, scale: int, seed: int):
    whole = {i: np.floor(np.array(x, dtype=np.float32).astype(float) * scale).astype(np.int64) for i, x in vectors.items()}
    first = sorted(whole, key=lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())[:k]
    c = [whole[i] for i in first]

    def assign():
        return {i: min((int(((x - y) ** 2).sum()), n) for n, y in enumerate(c)) for i, x in whole.items()}

    for _ in range(rounds):
        who = assign()
        c = [np.array([s // len(m) for s in sum(m).tolist()]) if (m := [whole[i] for i in whole if who[i][1] == n]) else c[n]
             for n in range(len(c))]
    return assign(), c


def test_against_all_distances(spark):
    r = random.Random(1)
    for spread, n in ((0.05, 300), (1.0, 200), (0.0, 30)):
        middles = [[r.uniform(-1, 1) for _ in range(6)] for _ in range(9)]
        data = {i: [x + r.gauss(0, spread) for x in r.choice(middles)] for i in range(n)}
        rows = [(i, x, "c", "v") for i, x in data.items()]
        got = centroids.cluster(spark.createDataFrame(rows, SCHEMA), k=12, rounds=4, pivots=4, length=6).collect()
        who, c = brute(data, 12, 4, 256, 2)
        total = sum(d for d, _ in who.values())
        each = {k: sum(d for d, n in who.values() if n == k) for k in range(12)}
        assert {g.vec_id: (g.distance, g.cluster) for g in got} == who
        assert all((g.cluster_inertia, g.inertia, g.centroid) == (each[g.cluster], total, c[g.cluster].tolist()) for g in got)


def test_bounds_spare_exact_distances_and_change_nothing():
    """Vectors in tight groups: most centroids are left out by their bounds, with the same answer."""
    g = np.random.default_rng(3)
    middles = g.integers(-2000, 2000, (30, 16))
    v = middles[g.integers(0, 30, 3000)] + g.integers(-20, 21, (3000, 16))
    pivots = centroids.far_apart(middles, 8)
    who, best, exact = centroids.nearest(v, centroids.distances(v, pivots), middles, pivots)
    d = ((v[:, None] - middles[None]) ** 2).sum(axis=2)
    assert (who == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert exact < 0.2 * d.size


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [0.5, 0.5]),
            (7, [0.0, 0.0]), (8, [1.0, 1.0]), (8, [1.0, 1.0])]
    d = spark.createDataFrame([(*r, "c", None) for r in rows], SCHEMA)
    got = centroids.cluster(d, k=40, rounds=2, length=2).collect()
    assert sorted((r.vec_id or 0, r.distance, r.inertia) for r in got) == [(0, 0, 0), (7, 0, 0), (8, 0, 0), (8, 0, 0)]
    assert len({r.cluster for r in got}) == 3
    assert centroids.cluster(d.limit(0), length=2).collect() == []
    assert centroids.cluster(d.where("vec_id < 7"), length=2).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]


def test_too_large_components_raise(spark):
    import pytest

    with pytest.raises(Exception, match="exceeds"):
        centroids.cluster(spark.createDataFrame([(1, [1e30, 0.0], "", "")], SCHEMA), length=2).collect()


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM read_parquet('/root/testdata/sf0.001/embeddings.parquet')")
    got = QUERIES["op13_centroids"](spark, "/root/testdata/sf0.001")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE['op13_centroids']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
