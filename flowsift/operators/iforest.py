"""Distributed isolation forest (M4, M5, M7, S8) after Liu, Ting & Zhou (ICDM 2008).

Sample: a pool of the rows with the smallest ``md5(id|seed)``, at most ``POOL`` of them however many
rows there are (a hash pre-filter leaves about twice as many to rank); every tree takes its ``psi``
rows from the pool by ``md5(id|tree|seed)``. Only pool rows are paired with trees.

Fit: all trees grow together, a level at a time. One aggregation gives each (tree, node) its size and
every feature's range; the split feature (among those that vary) and the threshold (uniform in the
range) are drawn from ``md5(tree|node|seed)``, so the forest is a function of the rows alone, whatever
the partitions, and SQL can grow the same trees. Rows then move to node 2k or 2k + 1. A level moves
trees x psi rows; nothing is grown in Python or in one task. The node table has at most
trees x (2 psi - 1) rows - a proven bound, which is what makes broadcasting it safe.

Score: ``mapInPandas`` walks all trees for an Arrow batch of rows at once (numpy), giving the paper
score ``2 ** (-E[h(x)] / c(psi))`` in (0, 1]; higher = more anomalous. Path lengths are summed as whole
millionths, so the sum does not depend on its order.
Scaling the features (M3) does not change this forest: split points are drawn uniformly in each node's
per-feature range, so an affine rescaling maps splits onto splits.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsift.config import ANOMALY_ID, ANOMALY_NAME, DETECTOR_ANOMALY, FEATURES
from flowsift.operators.metrics import calibrate, severity_band
from flowsift.operators.selection import percentile_linear
from flowsift.session import materialize

EULER = 0.5772156649015329
ANOMALY_FINDING_ORDER = 2000
NODE_SCHEMA = "tree_id int, node_id long, feature int, threshold double, size long, depth int"
#: Rows that the trees' samples are drawn from, at most.
POOL = 1 << 14
#: Path lengths are whole numbers of this part of a split.
PATH_UNIT = 1_000_000


def c_factor(n: np.ndarray | float) -> np.ndarray:
    """Average path length of an unsuccessful BST search: c(1)=0, c(2)=1,
    c(n) = 2 H(n-1) - 2 (n-1) / n with H(i) ~ ln(i) + Euler's constant."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    nb = n[big]
    out[big] = 2.0 * (np.log(nb - 1.0) + EULER) - 2.0 * (nb - 1.0) / nb
    return out


def feature_vector(cols=FEATURES) -> Column:
    """Ordered feature vector; a missing value counts as 0.0."""
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])


@dataclass
class IForestModel:
    nodes: pd.DataFrame
    n_trees: int
    psi: int
    n_features: int
    seed: int
    feature_names: list[str] = field(default_factory=list)
    calib_lo: float = 0.0
    calib_hi: float = 1.0
    metadata: dict = field(default_factory=dict)

    # ---- S8: persistence -------------------------------------------------
    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            f"{path}/model_nodes")
        meta = {"n_trees": self.n_trees, "psi": self.psi, "n_features": self.n_features, "seed": self.seed,
                "feature_columns": self.feature_names,
                "score_calibration": {"lo": self.calib_lo, "hi": self.calib_hi}, "metadata": self.metadata}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(
            f"{path}/model_meta")

    @staticmethod
    def load(spark: SparkSession, path: str, expect_features: list[str] | None = None) -> IForestModel | None:
        """A missing model gives None (the scorer then yields no findings); a model built
        on other feature columns raises."""
        try:
            meta = json.loads(spark.read.text(f"{path}/model_meta").first()["value"])
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        if expect_features is not None and meta["feature_columns"] != list(expect_features):
            raise ValueError("model feature columns differ from the current feature schema")
        nodes = spark.read.parquet(f"{path}/model_nodes").toPandas()  # bounded: trees x (2 psi - 1)
        cal = meta["score_calibration"]
        return IForestModel(nodes, meta["n_trees"], meta["psi"], meta["n_features"], meta["seed"],
                            meta["feature_columns"], cal["lo"], cal["hi"], meta.get("metadata", {}))


def _uniform(text: Column, place: int) -> Column:
    """A number in [0, 1) from 13 hex digits of md5(text), from ``place`` on (exact in a double)."""
    return F.conv(F.substring(F.md5(text), place, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _key(*parts: Column | str | int) -> Column:
    return F.concat_ws("|", *[F.col(x).cast("string") if isinstance(x, str) else F.lit(str(x)) for x in parts])


def pooled_sample(train: DataFrame, id_col: str, x_col: str, n_trees: int, psi: int, n: int, seed: int) -> DataFrame:
    """(tree_id, id, x): ``psi`` rows for each tree, drawn from the pool (rows of equal id are told apart by ``x``)."""
    rows = train.select(F.col(id_col).cast("string").alias("id"), F.col(x_col).alias("x"))
    rows = rows.withColumn("h", F.md5(_key("id", seed)))
    size = min(n, max(POOL, psi))
    share = 2.0 * size / n
    while True:
        # the pool's rows have the smallest hashes: a cut of the hash range that holds enough of them
        low = rows if share >= 1.0 else rows.where(F.col("h") < F.lit(f"{int(share * (1 << 52)):013x}"))
        pool = low.orderBy("h", "id", "x").limit(size)
        # a pool row's number keeps the order of rows of equal id; one window over POOL rows at most
        place = F.row_number().over(Window.orderBy("h", "id", "x"))
        pool = materialize(pool.select("id", "x", place.alias("place")), "iforest-pool")
        if share >= 1.0 or pool.count() == size:
            break
        share *= 2
    tree = F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree_id")
    # the pool is one file: its numbers are dealt out first, and trees draw numbers, never vectors
    drawers = pool.select("id", "place").repartition(train.sparkSession.sparkContext.defaultParallelism, "place")
    pairs = drawers.select("id", "place", tree).withColumn("h", F.md5(_key("id", "tree_id", seed)))
    w = Window.partitionBy("tree_id").orderBy("h", "id", "place")  # at most POOL rows a tree
    drawn = pairs.withColumn("r", F.row_number().over(w)).where(F.col("r") <= psi).select("tree_id", "place")
    return drawn.join(pool, "place").select("tree_id", "id", "x")


def fit(train: DataFrame, id_col: str, x_col: str = "x", n_trees: int = 200, max_samples: int = 256,
        seed: int = 42, feature_names: list[str] | None = None) -> IForestModel:
    """M4: fit ``n_trees`` isolation trees on ``train`` (rows with an id and a feature array)."""
    n = train.count()
    if n == 0:
        raise ValueError("no training rows")
    psi = min(max_samples, n)
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    d = int(len(train.select(x_col).first()[0]))
    rows = materialize(pooled_sample(train, id_col, x_col, n_trees, psi, n, seed).select(
        "tree_id", F.lit(1).cast("long").alias("node_id"), "x"), "iforest-level-0")
    levels = []
    for depth in range(max_depth + 1):
        ranges = rows.groupBy("tree_id", "node_id").agg(
            F.count(F.lit(1)).alias("size"),
            F.array(*[F.struct(F.lit(i).alias("f"), F.min(F.get("x", F.lit(i))).alias("lo"), F.max(F.get("x", F.lit(i))).alias("hi"))
                      for i in range(d)]).alias("features"))
        varying = F.filter("features", lambda r: (r["hi"] > r["lo"]) & (F.col("size") > 1) & F.lit(depth < max_depth))
        drawn = _key("tree_id", "node_id", seed)
        split = F.get("varying", F.floor(_uniform(drawn, 1) * F.size("varying")).cast("int"))
        nodes = ranges.select("tree_id", "node_id", "size", varying.alias("varying")).select(
            "tree_id", "node_id", "size", split.alias("s"), _uniform(drawn, 14).alias("u"))
        nodes = materialize(nodes.select(
            "tree_id", "node_id", F.coalesce("s.f", F.lit(-1)).alias("feature"),
            F.coalesce(F.col("s.lo") + F.col("u") * (F.col("s.hi") - F.col("s.lo")), F.lit(0.0)).alias("threshold"),
            "size", F.lit(depth).alias("depth")), f"iforest-nodes-{depth}")
        levels.append(nodes)
        if depth == max_depth:
            break
        inner = nodes.where("feature >= 0").select("tree_id", "node_id", "feature", "threshold")
        right = (F.get("x", F.col("feature")) > F.col("threshold")).cast("long")
        rows = materialize(rows.join(inner, ["tree_id", "node_id"]).select(
            "tree_id", (F.col("node_id") * 2 + right).alias("node_id"), "x"), f"iforest-level-{depth + 1}")
        if rows.isEmpty():
            break
    nodes = reduce(DataFrame.unionByName, levels).toPandas()  # bounded: n_trees x (2 psi - 1) rows
    return IForestModel(nodes, n_trees, psi, d, seed, list(feature_names or []),
                        metadata={"n_train": n, "n_estimators": n_trees, "max_samples": psi})


def _pack(model: IForestModel):
    nd = model.nodes
    width = int(nd["node_id"].max()) + 1
    shape = (model.n_trees, width)
    arr = {k: np.full(shape, fill, dtype=dt) for k, fill, dt in
           (("feature", -1, np.int32), ("threshold", 0.0, float), ("size", 0, np.int64), ("depth", 0, np.int32))}
    t, i = nd["tree_id"].to_numpy(), nd["node_id"].to_numpy()
    for k in arr:
        arr[k][t, i] = nd[k].to_numpy()
    arr["leaf_path"] = np.rint((arr["depth"] + c_factor(arr["size"])) * PATH_UNIT).astype(np.int64)
    return arr


def score_frame(df: DataFrame, model: IForestModel, x_col: str = "x", out: str = "raw_score") -> DataFrame:
    """M5: the paper score in (0, 1] for every row (Arrow batches, all trees per batch)."""
    from flowsift.session import ship_package

    spark = df.sparkSession
    ship_package(spark)
    packed = spark.sparkContext.broadcast(_pack(model))
    cpsi = float(c_factor(np.array([model.psi]))[0]) or 1.0
    n_trees = model.n_trees
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.DoubleType(), False)])

    def run(batches):
        a = packed.value
        for pdf in batches:
            if len(pdf) == 0:
                yield pdf.assign(**{out: pd.Series(dtype=float)})
                continue
            X = np.vstack(pdf[x_col].to_numpy()).astype(float)
            rows = np.arange(len(X))
            total = np.zeros(len(X), dtype=np.int64)
            for t in range(n_trees):
                feat, thr = a["feature"][t], a["threshold"][t]
                node = np.ones(len(X), dtype=np.int64)
                while True:
                    f = feat[node]
                    inner = f >= 0
                    if not inner.any():
                        break
                    xv = X[rows, np.where(inner, f, 0)]
                    node = np.where(inner, 2 * node + (xv > thr[node]), node)
                total += a["leaf_path"][t][node]
            yield pdf.assign(**{out: np.power(2.0, -(total / float(n_trees * PATH_UNIT)) / cpsi)})

    return df.mapInPandas(run, schema)


def calibrate_model(model: IForestModel, train_scored: DataFrame, raw: str = "raw_score",
                    q: float = 0.995) -> IForestModel:
    """M6 applied to the model: lo = min, hi = exact q-percentile of training raw scores."""
    lo = train_scored.agg(F.min(raw)).first()[0]
    hi = percentile_linear(train_scored, raw, q)
    model.calib_lo, model.calib_hi = float(lo), float(hi)
    return model


def anomaly_findings(flows: DataFrame, model: IForestModel | None, threshold: float = 0.5) -> DataFrame:
    """M7: calibrated score >= threshold -> an anomaly finding (confidence = score)."""
    from flowsift.operators.rules import FINDING_COLUMNS, IDENTITY

    if model is None:  # no model on disk: no anomaly findings
        return flows.select(*IDENTITY).limit(0).select(
            *IDENTITY, F.lit(0).alias("finding_order"), *[F.lit("").alias(c) for c in
                                                         ("detector", "rule_id", "name", "severity")],
            F.lit(0.0).alias("confidence"), F.lit("").alias("description"), F.lit("").alias("evidence"))
    scored = score_frame(flows.select(*IDENTITY, feature_vector().alias("x")), model)
    s = calibrate(F.col("raw_score"), model.calib_lo, model.calib_hi)
    desc = F.format_string("Isolation-forest anomaly score %.3f for flow %s:%d -> %s:%d", F.col("score"),
                           "src_ip", "src_port", "dst_ip", "dst_port")
    ev = F.to_json(F.struct(F.round("score", 4).alias("anomaly_score"), "src_ip", "dst_ip", "dst_port"))
    return (scored.withColumn("score", s).where(F.col("score") >= threshold)
            .select(*IDENTITY, F.lit(ANOMALY_FINDING_ORDER).alias("finding_order"),
                    F.lit(DETECTOR_ANOMALY).alias("detector"), F.lit(ANOMALY_ID).alias("rule_id"),
                    F.lit(ANOMALY_NAME).alias("name"), severity_band(F.col("score"), threshold).alias("severity"),
                    F.col("score").alias("confidence"), desc.alias("description"), ev.alias("evidence"))
            .select(*FINDING_COLUMNS))
