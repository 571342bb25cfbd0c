"""Quality rules as a short-circuit cascade (native).

Every rule is a reject condition over statistics of a text. ``plan`` times each rule by itself and counts
its rejections on a bounded sample; ``quality_rules`` then applies them one after the other, the one
with most rejections per second first. A rule's statistics are computed, inside a CASE, only for rows that
no earlier rule rejected, so a row pays for the rules up to its first rejection. Statistics named in
``always`` are computed for every row all the same (the query's base columns). The order changes the
work, never which rows pass.

Defined cases: a null or empty text has no words and no lines with words; repeated rows are judged
alike; very long texts are read whole; an empty table gives an empty result; other columns pass through
untouched (statistics carry the prefix ``_q_``).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch, words

GRAM = 5
SYMBOLS = "#*$%&|<>"
Steps = list[tuple[str, Column]]


def _repeats() -> Steps:
    """Words in five-word windows found twice or more: windows are named by 64-bit hashes. Texts whose names are
    all distinct stop there; for the others the (name, position) pairs are sorted, neighbours of equal name are
    repeats, and each repeat's position covers min(5, distance to the next repeat) words."""
    n = F.size("_q_hash")
    gram = F.transform(F.slice("_q_hash", 1, F.greatest(n - (GRAM - 1), F.lit(0))),
                       lambda x, i: F.xxhash64(x, *[F.get(F.col("_q_hash"), i + k) for k in range(1, GRAM)]))
    same = lambda x, i, j: F.get(F.col("_q_pairs"), j)["g"].eqNullSafe(x["g"])
    covered = F.aggregate(F.transform("_q_at", lambda p, i: F.least(
        F.lit(GRAM), F.coalesce(F.get(F.col("_q_at"), i + 1), p + GRAM) - p)), F.lit(0), lambda a, x: a + x)
    return [
        ("_q_hash", F.transform("_q_words", lambda x: F.xxhash64(x))),
        ("_q_gram", gram),
        ("_q_pairs", F.when(F.size(F.array_distinct("_q_gram")) < F.size("_q_gram"),
                            F.array_sort(F.transform("_q_gram", lambda x, i: F.struct(x.alias("g"), i.alias("p")))))),
        ("_q_at", F.array_sort(F.transform(
            F.filter("_q_pairs", lambda x, i: same(x, i, i + 1) | ((i > 0) & same(x, i, F.greatest(i - 1, F.lit(0))))),
            lambda x: x["p"]))),
        ("_q_repeats", F.coalesce(covered, F.lit(0)).cast("long"))]


def _count(array: str, pattern: str) -> Column:
    return F.size(F.filter(array, lambda x: x.rlike(pattern))).cast("long")


#: Steps that compute each statistic from the text ``_q_body``, its words ``_q_words`` and earlier steps.
STATISTICS: dict[str, Callable[[], Steps]] = {
    "chars": lambda: [("_q_chars", F.length(F.array_join("_q_words", "")).cast("long"))],
    "symbols": lambda: [("_q_symbols", (F.length("_q_body") - F.length(F.regexp_replace("_q_body", r"[#*$%&|<>]+", ""))).cast("long"))],
    "lines": lambda: [("_q_lines", F.filter(F.split("_q_body", "\n"), lambda x: x.rlike(r"[^\t-\r ]"))),
                      ("_q_line_count", F.size("_q_lines").cast("long"))],
    "dup_lines": lambda: [("_q_dup_lines", (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"))],
    "repeats": _repeats,
    "letters": lambda: [("_q_letters", _count("_q_words", r"\p{L}"))],
    "bullets": lambda: [("_q_bullets", _count("_q_lines", r"^[\t-\r ]*[-*•]"))],
    "ellipses": lambda: [("_q_ellipses", _count("_q_lines", r"(\.\.\.|…)[\t-\r ]*$"))],
}


@dataclass(frozen=True)
class Rule:
    name: str
    needs: tuple[str, ...]  # statistics, in order
    reject: Column


def default_rules() -> list[Rule]:
    """Limits in the manner of published web-corpus rules, on the lenient side."""
    n, lines = F.col("_q_n"), F.col("_q_line_count")
    return [
        Rule("few_words", (), n < 10),
        Rule("word_length", ("chars",), (F.col("_q_chars") < 2 * n) | (F.col("_q_chars") > 15 * n)),
        Rule("symbols", ("symbols",), F.col("_q_symbols") * 100 > 30 * n),
        Rule("dup_lines", ("lines", "dup_lines"), F.col("_q_dup_lines") * 100 > 50 * lines),
        Rule("repeats", ("repeats",), F.col("_q_repeats") * 100 > 20 * n),
        Rule("letters", ("letters",), F.col("_q_letters") * 100 < 50 * n),
        Rule("bullets", ("lines", "bullets"), (lines >= 3) & (F.col("_q_bullets") * 100 >= 90 * lines)),
        Rule("ellipses", ("lines", "ellipses"), (lines >= 3) & (F.col("_q_ellipses") * 100 > 30 * lines)),
    ]


def _prepared(docs: DataFrame, text_col: str) -> DataFrame:
    d = docs.withColumn("_q_body", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    d = d.withColumn("_q_words", words(F.col("_q_body")))
    return d.withColumn("_q_n", F.size("_q_words").cast("long")).withColumn("_q_rejected_by", F.lit(None).cast("string"))


def _computed(d: DataFrame, names: Sequence[str], need: Column | None) -> DataFrame:
    """``d`` with these statistics, where ``need`` holds (everywhere, if None); what it has already stays."""
    for name in names:
        for column, value in STATISTICS[name]():
            if column not in d.columns:
                d = d.withColumn(column, value if need is None else F.when(need, value))
    return d


def _applied(d: DataFrame, rule: Rule) -> DataFrame:
    """``d`` with ``_q_rejected_by`` set where no rule has rejected yet and this one does. A statistic that an earlier
    rule of the cascade left out is null only where ``_q_rejected_by`` is set."""
    d = _computed(d, rule.needs, F.col("_q_rejected_by").isNull())
    return d.withColumn("_q_rejected_by", F.when(F.col("_q_rejected_by").isNotNull(), F.col("_q_rejected_by"))
                        .when(rule.reject, F.lit(rule.name)))


def plan(docs: DataFrame, rules: list[Rule], text_col: str = "text", sample_rows: int = 512) -> list[Rule]:
    """``rules`` ordered by rejections per second on about ``sample_rows`` sampled documents (the
    fraction follows from the row count, which Parquet answers from its footers). A rule's cost is the time of
    its second run, when its code is compiled. Ties keep the given order."""
    share = min(1.0, sample_rows / max(docs.count(), 1))
    sample = scratch(docs.select(F.col(text_col).alias("text")).sample(share, seed=11).coalesce(8), "rule-sample")
    rows = sample.count()
    if not rows:
        return list(rules)
    rank = []
    for rule in rules:
        judged = _applied(_prepared(sample, "text"), rule).agg(F.count("_q_rejected_by"))
        hits = judged.first()[0]
        took = time.perf_counter()
        judged.collect()
        rank.append((hits / rows / max(time.perf_counter() - took, 1e-6), rule))
    return [r for _, r in sorted(rank, key=lambda x: -x[0])]


def quality_rules(docs: DataFrame, text_col: str = "text", rules: list[Rule] | None = None,
                  always: Sequence[str] = (), ordered: bool = False) -> DataFrame:
    """``docs`` with ``_q_n`` (words), ``_q_rejected_by`` (null: passed) and the statistics: those in ``always`` for
    every row, the others where the cascade came to them (else null). ``ordered``: keep the rules' order."""
    rules = default_rules() if rules is None else rules
    d = _computed(_prepared(docs, text_col), always, None)
    for rule in rules if ordered else plan(docs, rules, text_col):
        d = _applied(d, rule)
    inner = {"_q_body", "_q_words", "_q_lines", "_q_hash", "_q_gram", "_q_pairs", "_q_at"}
    return d.select(*[c for c in d.columns if c not in inner])
