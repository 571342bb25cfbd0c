"""Skew-safe ordered scans.

Window functions partitioned by a hot key put the whole key into one task. The
helpers here instead window over ``(key, bucket)`` - a bucket being a range of
the ordering column - and stitch bucket edges through a per-bucket summary whose
size is (#keys x #buckets), not #rows. Only the summary is windowed by the bare
key, and it has one row per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_marker(df: DataFrame, part: Sequence[str], bucket: str, order: str,
                  marker: Column, out: str) -> DataFrame:
    """``out`` = max of ``marker`` over all rows of ``part`` up to and including this row.

    ``marker`` is null on rows that are not markers and otherwise increases with
    ``order`` (e.g. ``struct(pkt_idx, ts)``), so the running max is the latest marker.
    """
    part = list(part)
    wl = (Window.partitionBy(*part, bucket).orderBy(order)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    df = df.withColumn("_mk", marker).withColumn("_loc", F.max("_mk").over(wl))
    summ = df.groupBy(*part, bucket).agg(F.max("_mk").alias("_bmax"))
    wb = Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(*part, bucket, F.max("_bmax").over(wb).alias("_carry"))
    return (df.join(summ, [*part, bucket], "left")
            .withColumn(out, F.coalesce("_loc", "_carry"))
            .drop("_mk", "_loc", "_carry"))


def prefix_sum(df: DataFrame, part: Sequence[str], bucket: str, order: str,
               values: Sequence[str], outs: Sequence[str]) -> DataFrame:
    """``outs[i]`` = running sum of ``values[i]`` over ``part`` ordered by ``order`` (RANGE
    frame: rows with an equal ``order`` value are all included). ``bucket`` must be a
    non-decreasing function of ``order`` so that peers share a bucket.
    """
    part = list(part)
    wl = (Window.partitionBy(*part, bucket).orderBy(order)
          .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    for v, o in zip(values, outs):
        df = df.withColumn(f"_loc_{o}", F.sum(v).over(wl))
    summ = df.groupBy(*part, bucket).agg(*[F.sum(v).alias(f"_btot_{o}") for v, o in zip(values, outs)])
    wb = Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(*part, bucket, *[
        F.coalesce(F.sum(f"_btot_{o}").over(wb), F.lit(0)).alias(f"_carry_{o}") for o in outs])
    df = df.join(summ, [*part, bucket], "left")
    for o in outs:
        df = df.withColumn(o, F.col(f"_loc_{o}") + F.col(f"_carry_{o}")).drop(f"_loc_{o}", f"_carry_{o}")
    return df
