"""Exact order statistics without funnelling a group into one task.

``percentile``/``row_number`` over a whole table put every value of the group into one
task. Here the k-th smallest value is found by histogram refinement: one aggregation
pass counts values per bucket of the current value range (a mergeable, map-side-combined
count), the bucket holding rank k becomes the new range, and the loop ends when the
range holds a single distinct value or few enough rows to sort. Each pass reads the
column once; the number of passes is logarithmic in the value spread.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096
SMALL = 100_000


def kth_smallest(df: DataFrame, col: str, k: int) -> float | None:
    """Exact k-th smallest (1-based) non-null value of ``col``."""
    v = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    lo_hi = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("n")).first()
    if lo_hi is None or lo_hi["n"] == 0 or not 1 <= k <= lo_hi["n"]:
        return None
    lo, hi, below = float(lo_hi["lo"]), float(lo_hi["hi"]), 0
    rng = v
    while True:
        if lo == hi:
            return lo
        cur = rng.where((F.col("v") >= lo) & (F.col("v") <= hi))
        n = cur.count()
        if n <= SMALL:
            w = Window.orderBy("v")  # bounded: at most SMALL rows remain
            r = cur.select("v", F.row_number().over(w).alias("r")).where(F.col("r") == k - below).first()
            return float(r["v"])
        width = (hi - lo) / BUCKETS
        b = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)), F.lit(BUCKETS - 1)).cast("int")
        hist = sorted(cur.groupBy(b.alias("b")).count().collect())  # <= BUCKETS rows
        acc = below
        for row in hist:
            if acc + row["count"] >= k:
                below = acc
                # the chosen bucket's own min/max become the next range
                mm = cur.where(b == row["b"]).agg(F.min("v").alias("a"), F.max("v").alias("z")).first()
                lo, hi = float(mm["a"]), float(mm["z"])
                rng = cur.where(b == row["b"])
                break
            acc += row["count"]


def percentile_linear(df: DataFrame, col: str, q: float) -> float | None:
    """Exact percentile with linear interpolation between the two closest ranks."""
    n = df.where(F.col(col).isNotNull()).count()
    if n == 0:
        return None
    pos = q * (n - 1)
    k0 = int(math.floor(pos))
    frac = pos - k0
    v0 = kth_smallest(df, col, k0 + 1)
    if frac == 0 or k0 + 1 >= n:
        return v0
    v1 = kth_smallest(df, col, k0 + 2)
    return v0 + frac * (v1 - v0)
