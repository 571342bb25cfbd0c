"""Scores and evaluation: unit score (P22), calibration (M6, P21), severity bands (P20),
ROC-AUC (M8), average precision (M9), classification report (M10).

Rank-based metrics need cumulative counts over the score order. Rows are first grouped
by distinct score (map-side combined), then a bucketed prefix sum over the distinct
scores (``stitch.prefix_sum``) gives the counts below each score - no global sort of
the rows and no single-task window over them. AUC is computed from integer counts
with one final division, so it is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.operators.selection import percentile_linear
from flowsift.operators.stitch import prefix_sum

SCORE_BUCKETS = 1 << 16


def unit_score(df: DataFrame, raw: str, out: str = "score") -> DataFrame:
    """(raw - min) / (max - min) over the batch; 0 when the batch is degenerate.
    min/max are two scalars from one aggregation, applied as literals."""
    mm = df.agg(F.min(F.col(raw).cast("double")).alias("lo"), F.max(F.col(raw).cast("double")).alias("hi")).first()
    if mm is None or mm["lo"] is None:
        return df.withColumn(out, F.lit(None).cast("double"))
    lo, hi = float(mm["lo"]), float(mm["hi"])
    if hi - lo < 1e-12:
        return df.withColumn(out, F.lit(0.0))
    return df.withColumn(out, (F.col(raw).cast("double") - F.lit(lo)) / F.lit(hi - lo))


def calibration_bounds(df: DataFrame, raw: str, q: float = 0.995) -> tuple[float | None, float | None]:
    """M6: lo = min, hi = exact linear-interpolated q-percentile of the raw score."""
    lo = df.agg(F.min(F.col(raw).cast("double"))).first()[0]
    return lo, percentile_linear(df, raw, q)


def calibrate(raw: Column, lo: float, hi: float) -> Column:
    """clip((raw - lo) / (hi - lo), 0, 1); a span under 1e-12 gives 0."""
    span = hi - lo
    if span < 1e-12:
        return F.lit(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (raw.cast("double") - F.lit(lo)) / F.lit(span)))


def severity_band(score: Column, threshold: float = 0.5) -> Column:
    """P20: below threshold -> 'none'; >= 0.9 critical; >= 0.7 high; else medium."""
    return (F.when(score < threshold, F.lit("none")).when(score >= 0.9, F.lit("critical"))
            .when(score >= 0.7, F.lit("high")).otherwise(F.lit("medium")))


def _score_table(df: DataFrame, score: str, label: str) -> DataFrame:
    """Distinct scores with positive/negative counts and cumulative counts at or below."""
    g = (df.groupBy(F.col(score).cast("double").alias("s"))
         .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")))
    g = g.withColumn("_sb", F.floor(F.col("s") * SCORE_BUCKETS).cast("long"))
    return prefix_sum(g, [], "_sb", "s", ["pos", "neg"], ["cum_pos", "cum_neg"])


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """M8: P(score_pos > score_neg) + 0.5 P(tie); null without positives or negatives."""
    t = _score_table(df, score, label)
    a = t.agg(
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg")) * 2 + F.col("pos") * F.col("neg")).alias("_num"),
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    den = F.col("_p") * F.col("_n") * 2
    return a.select(F.when(den > 0, F.col("_num").cast("double") / den.cast("double")).alias("roc_auc"))


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    """M9: sum over distinct thresholds (descending) of (R_n - R_(n-1)) * P_n, ties grouped."""
    t = _score_table(df, score, label)
    tot = df.agg(F.count_if(F.col(label) == 1).alias("P"), F.count(F.lit(1)).alias("T")).first()
    big_p, big_t = int(tot["P"]), int(tot["T"])
    if big_p == 0:
        return t.agg(F.lit(None).cast("double").alias("average_precision"))
    tp_ge = F.lit(big_p) - F.col("cum_pos") + F.col("pos")
    pred_ge = F.lit(big_t) - (F.col("cum_pos") + F.col("cum_neg")) + F.col("pos") + F.col("neg")
    term = (F.col("pos").cast("double") / F.lit(float(big_p))) * (tp_ge.cast("double") / pred_ge.cast("double"))
    return t.agg(F.sum(term).alias("average_precision"))


def classification_report(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """Per class precision/recall/F1/support, accuracy, macro and weighted averages;
    a zero denominator gives 0."""
    pred = F.col(score) >= threshold
    y = F.col(label) == 1
    c = df.agg(F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
               F.count_if(~pred & y).alias("fn"), F.count_if(~pred & ~y).alias("tn"))

    def div(a: Column, b: Column) -> Column:
        return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))

    def f1(p: Column, r: Column) -> Column:
        return F.when((p + r) > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0))

    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    c = c.select(
        div(tp, tp + fp).alias("p1"), div(tp, tp + fn).alias("r1"), (tp + fn).alias("s1"),
        div(tn, tn + fn).alias("p0"), div(tn, tn + fp).alias("r0"), (tn + fp).alias("s0"),
        div(tp + tn, tp + tn + fp + fn).alias("acc"))
    c = c.withColumn("f1", f1(F.col("p1"), F.col("r1"))).withColumn("f0", f1(F.col("p0"), F.col("r0")))
    s0, s1 = F.col("s0"), F.col("s1")
    tot = s0 + s1

    def wavg(a: str, b: str) -> Column:
        return div(F.col(a) * s0 + F.col(b) * s1, tot)

    rows = [
        ("0", F.col("p0"), F.col("r0"), F.col("f0"), s0),
        ("1", F.col("p1"), F.col("r1"), F.col("f1"), s1),
        ("accuracy", F.col("acc"), F.col("acc"), F.col("acc"), tot),
        ("macro avg", (F.col("p0") + F.col("p1")) / 2, (F.col("r0") + F.col("r1")) / 2,
         (F.col("f0") + F.col("f1")) / 2, tot),
        ("weighted avg", wavg("p0", "p1"), wavg("r0", "r1"), wavg("f0", "f1"), tot),
    ]
    arr = F.array(*[F.struct(F.lit(n).alias("class"), p.alias("precision"), r.alias("recall"),
                             f.alias("f1_score"), s.cast("long").alias("support")) for n, p, r, f, s in rows])
    return c.select(F.explode(arr).alias("x")).select("x.*")
