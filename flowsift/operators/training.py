"""Training-set operators: labelled flows, stratified split (M1), benign filter (M2),
standard-scaler parameters (M3) and training metadata (M11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsift.config import FEATURES

HASH_PREFIX = 5  # hex digits of the split hash used as histogram bucket (16^5 buckets)


def labelled_flows(flows: DataFrame, findings: DataFrame) -> DataFrame:
    """Flows with label 1 when any signature finding fired on them, else 0."""
    hit = findings.select("flow_id").distinct().withColumn("_hit", F.lit(1))
    return (flows.join(hit, "flow_id", "left")
            .select("flow_id", *FEATURES, F.coalesce(F.col("_hit"), F.lit(0)).alias("label")))


def split_hash(id_col: str, seed: int) -> F.Column:
    return F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))))


def stratified_split(df: DataFrame, id_col: str, label_col: str = "label", test_frac: float = 0.25,
                     seed: int = 42) -> DataFrame:
    """M1: exact, reproducible stratified split. Within each label, the
    ``round(n * test_frac)`` rows with the smallest md5(id|seed) form the test set.

    No window over a whole label: a histogram over the first hex digits of the hash
    (aggregation with map-side combine) finds the bucket where the test quota ends;
    only that bucket's rows (about n / 16^5) are ranked."""
    d = (df.withColumn("_h", split_hash(id_col, seed))
         .withColumn("_hb", F.substring("_h", 1, HASH_PREFIX)))
    hist = d.groupBy(label_col, "_hb").agg(F.count(F.lit(1)).alias("_c"))
    wl = Window.partitionBy(label_col).orderBy("_hb")  # one row per (label, bucket): bounded
    hist = (hist.withColumn("_cum", F.sum("_c").over(wl.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_n", F.sum("_c").over(Window.partitionBy(label_col)))
            .withColumn("_k", F.floor(F.col("_n") * F.lit(test_frac) + F.lit(0.5)).cast("long")))
    cross = (hist.where((F.col("_cum") >= F.col("_k")) & (F.col("_cum") - F.col("_c") < F.col("_k")))
             .select(label_col, F.col("_hb").alias("_hstar"),
                     (F.col("_k") - (F.col("_cum") - F.col("_c"))).alias("_need")))
    # one row per label value: broadcast while the label domain is small (checked), else shuffle
    n_labels = cross.count()
    d = d.join(F.broadcast(cross) if n_labels <= 100_000 else cross, label_col, "left").withColumn(
        "_hstar", F.coalesce(F.col("_hstar"), F.lit("")))
    outside = d.where(F.col("_hb") != F.col("_hstar")).withColumn(
        "split", F.when(F.col("_hb") < F.col("_hstar"), F.lit("test")).otherwise(F.lit("train")))
    wr = Window.partitionBy(label_col, "_hb").orderBy("_h", id_col)
    inside = (d.where(F.col("_hb") == F.col("_hstar"))
              .withColumn("_r", F.row_number().over(wr))
              .withColumn("split", F.when(F.col("_r") <= F.col("_need"), F.lit("test")).otherwise(F.lit("train")))
              .drop("_r"))
    return outside.unionByName(inside).drop("_h", "_hb", "_hstar", "_need")


def benign_train(split_df: DataFrame, label_col: str = "label") -> DataFrame:
    """M2: the model is fitted on benign rows of the training split only."""
    return split_df.where((F.col("split") == "train") & (F.col(label_col) == 0))


def scaler_params(df: DataFrame, features=FEATURES) -> DataFrame:
    """M3: per-feature mean and population std; zero-variance features keep scale 1."""
    aggs = []
    for f in features:
        aggs += [F.avg(f).alias(f"m_{f}"), F.stddev_pop(f).alias(f"s_{f}")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(f).alias("feature"), F.col(f"m_{f}").alias("mean"),
                 F.col(f"s_{f}").alias("std")) for i, f in enumerate(features)]))
    return (one.select(rows.alias("r")).select("r.*")
            .withColumn("scale", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std"))))


def training_metadata(split_df: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows, attack rate, split sizes (one row)."""
    return split_df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.col(label_col).cast("double")).alias("attack_rate"),
        F.count_if((F.col("split") == "train") & (F.col(label_col) == 0)).alias("n_train_benign"),
        F.count_if(F.col("split") == "test").alias("n_test"),
        F.count_if((F.col("split") == "test") & (F.col(label_col) == 1)).alias("n_test_attack"),
    )


def training_run(labelled: DataFrame, id_col: str, features=FEATURES, label_col: str = "label", test_frac: float = 0.25,
                 seed: int = 42, n_trees: int = 200, max_samples: int = 256, threshold: float = 0.5):
    """The whole run (M1-M6, M8-M11): split, fit on the benign training rows, calibrate on their scores, judge the
    test split. Returns the model; ``metadata`` holds the parameters and ``report``, a name and a number each,
    and is saved with it."""
    from flowsift.operators import iforest as ifo
    from flowsift.operators.metrics import average_precision, calibrate, classification_report, roc_auc
    from flowsift.session import materialize

    split = stratified_split(labelled, id_col, label_col, test_frac, seed)
    split = materialize(split.select(id_col, F.col(label_col).alias("label"), "split", ifo.feature_vector(features).alias("x")), "train-split")
    train = benign_train(split)
    model = ifo.fit(train, id_col, n_trees=n_trees, max_samples=max_samples, seed=seed, feature_names=list(features))
    needed = split.where((F.col("split") == "test") | (F.col("label") == 0))
    scored = materialize(ifo.score_frame(needed, model).select("split", "label", "raw_score"), "train-scores")
    model = ifo.calibrate_model(model, benign_train(scored))
    test = scored.where(F.col("split") == "test").select(
        "label", calibrate(F.col("raw_score"), model.calib_lo, model.calib_hi).alias("score"))
    report = {k: float(v) for k, v in training_metadata(split).first().asDict().items()}
    report |= {"calib_lo": model.calib_lo, "calib_hi": model.calib_hi,
               "roc_auc": roc_auc(test, "score", "label").first()[0],
               "average_precision": average_precision(test, "score", "label").first()[0]}
    for r in classification_report(test, "score", "label", threshold).collect():  # five rows
        report |= {f"{r['class']} {m}": float(r[m]) for m in ("precision", "recall", "f1_score", "support")}
    model.metadata |= {"test_frac": test_frac, "threshold": threshold, "report": report}
    return model
