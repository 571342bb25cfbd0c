"""The dealt operators bound to the driver's tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, centroids, licenses, linededup, mixing, neardup, packing, quality, recompress, runs, secrets, toxicity
from .common import table, words


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = licenses.license_scan(table(spark, sf_dir, "documents"))
    base = F.array_sort(F.array_distinct("hits.label"))
    found = F.coalesce(F.col("matches.label"), F.array().cast("array<string>"))
    score = F.when(F.size("hits") > 0, 1.0).otherwise(F.coalesce(F.array_max("matches.containment"), F.lit(0.0)))
    return d.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_base"),
        F.array_min("hits.at").alias("first_word"), F.array_max("hits.at").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, found)), ",").alias("labels"), score.alias("score"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = recompress.substring_dedup(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_words", "n_removed", F.col("sha").alias("kept_sha256"))


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    d = toxicity.score(docs, model)
    return d.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op6_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_dups(table(spark, sf_dir, "documents"), k=4).select("doc_id", "n_shingles", "component_id", "kept")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False).drop("ids")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = linededup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    kept = F.coalesce(F.array_join("_l_kept", "\n"), F.lit(""))
    return d.select(
        "doc_id", F.col("_l_lines").cast("long").alias("n_lines"),
        F.col("_l_boilerplate").cast("long").alias("n_boilerplate"),
        (F.col("_l_lines") - F.coalesce(F.size("_l_kept"), F.lit(0))).cast("long").alias("n_removed"),
        F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                   always=("chars", "symbols", "lines", "dup_lines", "repeats"))
    n, repeats = F.col("_q_n"), F.col("_q_repeats")
    base_failed = (n < 10) | (repeats * 100 > n * 20)
    return judged.select(
        "doc_id", n.alias("n_words"), F.col("_q_chars").alias("word_chars"),
        F.col("_q_symbols").alias("n_symbols"), F.col("_q_dup_lines").alias("n_dup_lines"),
        repeats.alias("n_repeat_words"), base_failed.alias("base_failed"),
        (~base_failed & F.col("_q_rejected_by").isNull()).alias("kept"))


def _spans(spans):
    kinds = F.array(*[F.lit(k) for k in secrets.KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["stop"].cast("string"))), ",")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = secrets.scan(table(spark, sf_dir, "documents"))
    count = [F.size(F.filter("base", lambda x: x["kind"] == 0)).cast("long").alias("n_assign"),
             F.size(F.filter("base", lambda x: x["kind"] == 1)).cast("long").alias("n_access"),
             F.size(F.filter("base", lambda x: x["kind"] == 2)).cast("long").alias("n_hex")]
    return d.select("doc_id", *count, F.sha2(_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                    _spans(F.concat("base", "found")).alias("spans"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    d = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path).withColumn("ids_sha256", F.sha2("ids", 256)), path)
    return d.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text), a tenth of them (by crc32 of the id) made periodic from some word on; rows without
    an id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    d = docs.select("doc_id", "text", words(F.col("text")).alias("w"), h.alias("h"))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    at = (g % n).cast("int")
    period = (1 + F.floor((n - at) / (3 + g % 8))).cast("int")
    repeats = F.ceil((n - at) / period).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", at + 1, period), repeats)), F.lit(1), n - at)
    text = F.array_join(F.concat(F.slice("w", F.lit(1), at), tail), " ")
    return d.select("doc_id", F.when((F.col("h") % 10 == 0) & (n > 0), text).otherwise(F.col("text")).alias("text"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = runs.find_runs(planted(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    d = d.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                 F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                 F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    length = -F.col("best.l")
    return d.select("doc_id", "n_runs", F.col("best.s").alias("start"), length.alias("length"), F.col("best.p").alias("period"),
                    F.floor(length * 1000 / F.col("best.p")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = centroids.cluster(table(spark, sf_dir, "embeddings"))
    components = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return d.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                    F.sha2(components.cast("binary"), 256).alias("centroid_sha256"))


QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_substrings": op2_substrings,
    "op3_ann": op3_ann,
    "op4_mixing": op4_mixing,
    "op5_toxicity": op5_toxicity,
    "op6_near_dups": op6_near_dups,
    "op7_packing": op7_packing,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality": op9_quality,
    "op10_secrets": op10_secrets,
    "op11_bpe": op11_bpe,
    "op12_runs": op12_runs,
    "op13_centroids": op13_centroids,
}
