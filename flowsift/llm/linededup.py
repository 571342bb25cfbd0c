"""Cross-site boilerplate lines by their distinct-site spread (native).

A line (trimmed, with at least one word) is boilerplate when it stands on ``min_sites`` or more
distinct sites. Lines are named by two hashes. Names seen fewer than ``min_sites`` times cannot
reach the limit and leave first (a map-side combined count). For the rest, HyperLogLog sketches of
the sites are built per line and merged by the aggregation; lines whose estimate lies further from
the limit than the sketch's error are decided by it, and near-threshold lines get exact distinct
counts.

``clean`` (the pipeline) cuts them from every document that has a line of its own; a document of
boilerplate alone is a copy of something rather than a page with boilerplate, and is left whole to
the near-duplicate stage; so no document is emptied. ``line_dedup`` by itself follows the rule of its
SQL twin: a document loses its boilerplate lines if that takes at most half of its words.

Defined cases: null and empty texts have no lines and stay as they are; a null site is a site of
its own; rows that agree in id and text are each cleaned; texts of very many lines take time in
proportion to them; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KEY, SPACES, doc_key, join_key, scratch

#: Sketch size: 2^12 registers, relative error 1.04 / sqrt(2^12) = 1.6 %.
LG_K = 12
MIN_SITES = 8
LINE = ["l1", "l2"]


def line_table(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """One row for each line with a word: document key, place, words, site, line name."""
    # the key is made below the generator, once a document; beside it, it would be made for every line
    d = docs.select(*doc_key(F.col(id_col), F.col(text_col)),
                    F.coalesce(F.col(site_col).cast("string"), F.lit("\0")).alias("site"),
                    F.split(F.coalesce(F.col(text_col), F.lit("")), "\n").alias("split"))
    d = d.select(*KEY, "site", F.posexplode("split").alias("place", "raw"))
    d = d.withColumn("line", F.btrim("raw", F.lit(" \t\x0b\x0c\r"))).where(F.length("line") > 0)
    return d.select(*KEY, "place", "site", F.size(F.split("line", SPACES)).alias("n"),
                    F.xxhash64("line").alias("l1"), F.hash("line").alias("l2"))


def boilerplate(lines: DataFrame, min_sites: int) -> tuple[DataFrame, DataFrame]:
    """(lines frequent enough to matter, names of boilerplate lines)."""
    often = lines.groupBy(*LINE).agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= min_sites)
    often = scratch(lines.join(often.select(*LINE), LINE, "left_semi"), "line-often")
    spread = often.groupBy(*LINE).agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("spread"))
    spread = scratch(spread, "line-spread")
    error = max(1, math.ceil(4 * 1.04 / math.sqrt(2 ** LG_K) * min_sites))
    far = spread.where(F.col("spread") > min_sites + error).select(*LINE)
    near = spread.where(F.abs(F.col("spread") - min_sites) <= error).select(*LINE)
    exact = often.join(near, LINE, "left_semi").groupBy(*LINE).agg(F.count_distinct("site").alias("sites"))
    return often, far.unionByName(exact.where(F.col("sites") >= min_sites).select(*LINE))


def line_dedup(docs: DataFrame, min_sites: int = MIN_SITES, id_col: str = "doc_id", text_col: str = "text",
               site_col: str = "source", spare_copies_only: bool = False) -> DataFrame:
    """``docs`` with ``_l_lines`` (lines), ``_l_boilerplate`` (boilerplate lines found) and
    ``_l_kept`` (array of the lines that stay; null text: null). With ``spare_copies_only`` a document
    is spared only if it has no line of its own, else if boilerplate makes more than half of its words."""
    lines = scratch(line_table(docs, id_col, text_col, site_col), "lines")
    often, names = boilerplate(lines, min_sites)
    hits = often.join(names, LINE, "left_semi").groupBy(*KEY).agg(F.array_sort(F.collect_set(F.struct("place", "n"))).alias("hits"))
    hits = hits.select(*KEY, F.col("hits.place").alias("_l_places"),
                       F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("_l_lost"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")  # its names clash with none
    d = join_key(docs.select(whole, *doc_key(F.col(id_col), F.col(text_col))), hits)
    text = F.col("doc").getField(text_col)
    raw = F.split(text, "\n")
    n_words: Column = F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), ""))
    cut = (F.col("_l_lost") < n_words) if spare_copies_only else (F.col("_l_lost") * 2 <= n_words)
    # edges and lines are made once a row: a generator's output is never made anew inside the lambdas below
    edges = F.when(cut, F.concat(F.array(F.lit(-1)), F.col("_l_places"), F.array(F.size(raw))))
    d = d.select("doc", "_l_places", F.explode(F.array(F.struct(raw.alias("raw"), edges.alias("edges")))).alias("once"))
    d = d.select("doc", "_l_places", F.col("once.raw").alias("_l_raw"), F.explode(F.array("once.edges")).alias("_l_edges"))
    # one flag a line, from the gaps between cut lines; the flag past the last line meets none
    stays = F.flatten(F.transform(F.sequence(F.lit(0), F.size("_l_edges") - 2), lambda k: F.concat(
        F.array_repeat(F.lit(True), F.get("_l_edges", k + 1) - F.get("_l_edges", k) - 1), F.array(F.lit(False)))))
    flagged = F.filter(F.zip_with("_l_raw", stays, lambda x, f: F.struct(x.alias("x"), f.alias("f"))), lambda y: y["f"])
    kept = F.when(F.col("_l_edges").isNull(), F.col("_l_raw")).otherwise(F.transform(flagged, lambda y: y["x"]))
    return d.select("doc.*", F.coalesce(F.size("_l_raw"), F.lit(0)).alias("_l_lines"),
                    F.coalesce(F.size("_l_places"), F.lit(0)).alias("_l_boilerplate"), kept.alias("_l_kept"))


def clean(docs: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with the boilerplate lines cut from ``text_col`` wherever a document has lines of its own;
    all rows and columns stay."""
    d = line_dedup(docs, text_col=text_col, spare_copies_only=True, **settings)
    return d.withColumn(text_col, F.array_join("_l_kept", "\n")).select(*docs.columns)
