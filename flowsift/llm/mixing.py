"""Mixing sources to target weights by capped water-filling (native).

``water_fill`` turns source sizes and weights into targets: every source gets the budget in
proportion to its weight, a source that would need more than ``max_epochs`` passes is clamped
there, and what it cannot use is shared among the rest by weight until nothing is above its
clamp. Sorting sources by (clamp / weight) finds that fixpoint in one pass: the clamped sources
are a prefix of that order.

``mix`` takes whole repetitions of every document and spends the remaining fraction on documents
in seeded hash order. The order is never sorted globally: hash buckets are summed first (map-side
combined), the bucket holding the cut is found on the bucket sums, and rows are ordered inside
that one bucket only, so a source with a third of all rows is no hot spot.

Defined cases: a null text has size 0; a null source is a source of its own and sorts last; a
source without words gets target 0; repeated rows each take part; very long texts count whole; an
empty table gives an empty result. Columns other than id, text and source are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import KEY, doc_key, scratch, words

#: Hex digits of the seeded hash that name a bucket: 65,536 buckets for each source.
BUCKET_DIGITS = 4


def water_fill(sources: DataFrame, share_pct: int, max_epochs: int) -> DataFrame:
    """``sources(source, source_size, weight)`` with ``target`` added. One row for each source, so
    the global windows here run over the configuration, not over documents."""
    cap = F.col("source_size") * F.lit(max_epochs)
    order = W.orderBy((cap / F.col("weight")), F.col("source").asc_nulls_last())
    every = W.partitionBy(F.lit(0))
    s = sources.withColumn("cap", cap).withColumn("total", F.sum("source_size").over(every))
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    s = s.withColumn("before", before).withColumn("rest", rest)
    # clamped: the level reached without it would ask for more than its clamp
    s = s.withColumn("clamped", (F.col("total") * share_pct - F.col("before") * 100) * F.col("weight")
                     > F.col("cap") * F.col("rest") * 100)
    used = F.sum(F.when(F.col("clamped"), F.col("cap")).otherwise(0)).over(every)
    open_weight = F.sum(F.when(F.col("clamped"), 0).otherwise(F.col("weight"))).over(every)
    s = s.withColumn("used", used).withColumn("open_weight", open_weight)
    level = ((F.col("total") * share_pct - F.col("used") * 100) * F.col("weight")).cast("double") \
        / (F.col("open_weight") * 100).cast("double")
    target = F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(level)
    return s.select("source", "source_size", target.alias("target"))


def weigh(sources: DataFrame, weights: Sequence[int]) -> DataFrame:
    """Weights dealt to sources by code point order (null last), repeating."""
    rn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    deal = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (rn % len(weights) + 1).cast("int"))
    return sources.withColumn("weight", deal.cast("long"))


def sizes(docs: DataFrame, seed: int, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", by_text: bool = False) -> DataFrame:
    """Narrow pass over the texts: (doc_id, source, size, key, bucket). The key is drawn from id and text, so
    rows without an id, or of one id, spread like others; with ``by_text`` the columns KEY are added."""
    body = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))
    ident = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), body)
    own = doc_key(F.col(id_col), F.col(text_col)) if by_text else []
    return docs.select(
        *own,
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.size(words(F.col(text_col))).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), ident).cast("binary")).alias("key"),
    ).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share_pct: int = 150, max_epochs: int = 2,
        seed: int = 17, whole: bool = False, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", by_text: bool = False) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for each document, with ``by_text`` KEY before.

    ``taken`` counts words, repeats included. The document at the cut gives the words still owed,
    so each source takes floor(target) words exactly; with ``whole`` it is taken entirely if at
    least half of it is owed, else not at all (then ``taken`` is a multiple of ``size``). Rows
    that share an id, or have none, draw by their texts, each on its own.
    """
    d = scratch(sizes(docs, seed, id_col, text_col, source_col, by_text), "mix-sizes")
    by_bucket = d.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    by_bucket = scratch(by_bucket, "mix-buckets")
    sources = by_bucket.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    sources = water_fill(weigh(sources, weights), share_pct, max_epochs)
    owed = F.floor("target").cast("long")
    reps = F.when(F.col("source_size") > 0, F.floor(owed / F.col("source_size"))).otherwise(0).cast("long")
    sources = scratch(sources.withColumn("reps", reps)
                      .withColumn("rest", owed - F.col("reps") * F.col("source_size")), "mix-targets")
    start = F.sum("bucket_size").over(W.partitionBy("source").orderBy("bucket")) - F.col("bucket_size")
    b = by_bucket.withColumn("bucket_start", start)
    b = b.join(sources, b.source.eqNullSafe(sources.source)).select(
        b.source, "bucket", "bucket_start", "bucket_size", "source_size", "target", "reps", "rest")
    d = d.join(b, d.source.eqNullSafe(b.source) & (d.bucket == b.bucket)).drop(b.source).drop(b.bucket)
    cut = (F.col("bucket_start") < F.col("rest")) & (F.col("rest") < F.col("bucket_start") + F.col("bucket_size"))
    inside = W.partitionBy("source", "bucket").orderBy("key", "size").rowsBetween(W.unboundedPreceding, -1)
    at_cut = d.where(cut).withColumn("before", F.col("bucket_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    clear = d.where(~cut).withColumn("before", F.when(F.col("bucket_start") >= F.col("rest"), F.col("rest"))
                                     .otherwise(F.col("rest") - F.col("bucket_size")))
    d = clear.unionByName(at_cut)
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    if whole:
        extra = F.when((extra > 0) & (extra * 2 >= F.col("size")), F.col("size")).otherwise(0)
    return d.select(*(KEY if by_text else []), "doc_id", "source", "size", "source_size", "target",
                    (F.col("reps") * F.col("size") + extra).cast("long").alias("taken"))


def materialize_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **settings) -> DataFrame:
    """The mixed documents themselves: each row of ``docs`` as often as the mix takes it (whole
    documents). Rows draw by id and text, so null or shared ids change nothing; only rows equal in id,
    text and source share a take, the mean of theirs, rounded."""
    taken = mix(docs, whole=True, by_text=True, id_col=id_col, text_col=text_col, source_col=source_col, **settings)
    taken = taken.groupBy(*KEY, F.col("source").alias("k_source")).agg(
        F.round(F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).cast("int").alias("times"))
    taken = taken.where("times > 0").withColumnsRenamed({k: f"t_{k}" for k in [*KEY, "k_source"]})
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")  # its names clash with none
    d = docs.select(whole, *doc_key(F.col(id_col), F.col(text_col)), F.col(source_col).cast("string").alias("k_source"))
    same = [F.col(k).eqNullSafe(F.col(f"t_{k}")) for k in [*KEY, "k_source"]]
    d = d.join(taken, same[0] & same[1] & same[2] & same[3])
    return d.select("doc", F.explode(F.sequence(F.lit(1), F.col("times")))).select("doc.*")
