"""License scan: exact set-similarity join of text blocks with licence templates (native).

A block is a window of ``BLOCK`` words, one every ``BLOCK / 2`` words, so that every passage of up
to ``BLOCK / 2`` words lies whole in some block. A block matches a template when it holds at least
``threshold`` of the template's distinct words: overlap >= alpha = ceil(threshold * |T|).

The join is exact and prunes by the classical filters over one global order, words by ascending
number of blocks that hold them (counted over all documents), ties by the word:

* length: a block keeps only its words that some template has; with fewer than the smallest alpha
  of them it can match nothing;
* prefix: a block B and template T with overlap >= alpha share a word among the first
  |B| - alpha + 1 words of B and the first |T| - alpha + 1 words of T, so only those are joined;
* position: a shared word at places i and j leaves at most min(|B| - i, |T| - j) common words.

Survivors are verified by their full intersection. The template side is a few hundred words of
configuration (checked below) and is the only thing broadcast; the text side is never shuffled.

Defined cases: null and empty texts have no words, no blocks and no labels; rows that agree in id
and text are each returned; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KEY, doc_key, join_key, scratch

BLOCK = 256
THRESHOLD = 0.8
#: Largest total number of template words that may be broadcast.
MAX_TEMPLATE_WORDS = 20_000

# The phrases of the contract and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Usual wording of public licence notices, with the labels the join gives.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except "
                         "in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0",
    "mit-line": "Released under the MIT License.",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the Software), to deal in the Software without restriction, "
                  "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                  "sublicense, and/or sell copies of the Software",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                      "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                      "the License, or (at your option) any later version.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-4.0-short": "Content available under CC BY 4.0 license.",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                  "provided that the following conditions are met",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
                      "of the MPL was not distributed with this file, You can obtain one at "
                      "https://mozilla.org/MPL/2.0/",
}

#: Separators left after lower-casing: all of ASCII but digits and a-z.
SEPARATORS = r"[\x00-/:-`{-\x7f]+"


def license_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. ``lower`` also
    changes letters beyond ASCII, which no phrase or template has; the two letters it would turn
    into ASCII ones (U+0130, U+212A) are replaced by another letter beyond ASCII first."""
    body = F.coalesce(text, F.lit(""))
    odd = body.contains("İ") | body.contains("K")
    body = F.when(odd, F.regexp_replace(body, "[İK]", "ı")).otherwise(body)
    return F.array_remove(F.split(F.lower(body), SEPARATORS), "")


def template_sets(templates: Mapping[str, str], threshold: float) -> list[tuple[str, list[str], int]]:
    """(label, distinct words, alpha) of each template."""
    import re

    out = []
    for label, text in sorted(templates.items()):
        found = sorted(set(re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())))
        if not found or len(found) * 2 > BLOCK:
            raise ValueError(f"template {label!r} must have 1 to {BLOCK // 2} distinct words")
        out.append((label, found, math.ceil(round(threshold * len(found), 9))))
    if sum(len(t[1]) for t in out) > MAX_TEMPLATE_WORDS:
        raise ValueError("too many template words to broadcast")
    return out


def phrase_starts(w: Column, phrases: Mapping[str, str]) -> Column:
    """array<struct<at, label>>: every place where a phrase's words stand one after another."""
    def places(phrase: str, label: str) -> Column:
        def stands(i: Column) -> Column:
            out = F.lit(True)
            for k, part in enumerate(phrase.split()):
                out = out & F.coalesce(F.get(w, i + k) == part, F.lit(False))
            return out

        at = F.filter(F.sequence(F.lit(0), F.size(w) - 1), stands)
        return F.transform(at, lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))

    hits = [places(p, label) for p, label in phrases.items()]
    none = F.array().cast("array<struct<at:bigint,label:string>>")
    keys = F.array(*[F.lit(p.split()[-1]) for p in phrases])
    return F.when(F.arrays_overlap(w, keys), F.concat(*hits)).otherwise(none)


def scan_texts(docs: DataFrame, sets: list[tuple[str, list[str], int]], phrases: Mapping[str, str],
               id_col: str, text_col: str) -> DataFrame:
    """One narrow pass: key, number of words, phrase places, and blocks that pass the length filter."""
    vocabulary = F.array(*[F.lit(x) for x in sorted({x for _, ws, _ in sets for x in ws})])
    least = min(a for _, _, a in sets)
    d = docs.select(*doc_key(F.col(id_col), F.col(text_col)), license_words(F.col(text_col)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - BLOCK // 2, F.lit(1)), F.lit(BLOCK // 2))
    blocks = F.transform(starts, lambda s: F.struct(
        (s - 1).cast("long").alias("block"), F.array_intersect(F.slice("w", s, BLOCK), vocabulary).alias("tokens")))
    return d.select(*KEY, F.size("w").cast("long").alias("n_words"),
                    phrase_starts(F.col("w"), phrases).alias("hits"),
                    F.filter(blocks, lambda b: F.size(b["tokens"]) >= least).alias("blocks"))


def match_blocks(blocks: DataFrame, sets: list[tuple[str, list[str], int]]) -> DataFrame:
    """The join proper. ``blocks``: key columns, ``block``, ``tokens`` (distinct template words).
    Returns key columns, block, label, overlap, containment, one row for each match."""
    spark = blocks.sparkSession
    counted = blocks.select(F.explode("tokens").alias("token")).groupBy("token").count()
    # at most one row for each template word
    df = {r.token: r["count"] for r in counted.collect()}
    every = sorted({x for _, ws, _ in sets for x in ws}, key=lambda x: (df.get(x, 0), x))
    rank = {x: i for i, x in enumerate(every)}
    prefix = []
    for label, ws, alpha in sets:
        ordered = sorted(ws, key=rank.__getitem__)
        prefix += [(rank[x], j, label, len(ws), alpha, ordered) for j, x in enumerate(ordered[: len(ws) - alpha + 1])]
    t = spark.createDataFrame(prefix, "rank int, j int, label string, t_size int, alpha int, t_tokens array<string>")
    least = min(a for _, _, a in sets)
    order = F.array(*[F.lit(x) for x in every])
    b = blocks.withColumn("ranks", F.array_sort(F.transform("tokens", lambda x: F.array_position(order, x).cast("int") - 1)))
    b = b.withColumn("b_size", F.size("ranks"))
    first = F.slice("ranks", 1, F.col("b_size") - (least - 1))
    b = b.select("*", F.posexplode(first).alias("i", "rank")).drop("ranks")
    m = b.join(F.broadcast(t), "rank").where(
        (F.col("b_size") >= F.col("alpha")) & (F.least(F.col("b_size") - F.col("i"), F.col("t_size") - F.col("j")) >= F.col("alpha")))
    m = m.withColumn("overlap", F.size(F.array_intersect("tokens", "t_tokens"))).where(F.col("overlap") >= F.col("alpha"))
    # a match meets once for each word that both prefixes share: one row is kept
    return m.groupBy(*KEY, "block", "label").agg(
        F.first("overlap").alias("overlap"), F.first(F.col("overlap") / F.col("t_size")).alias("containment"))


def license_scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, phrases: Mapping[str, str] = PHRASES,
                 threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, hits, matches): phrase places as array<struct<at, label>> and the matched
    blocks as array<struct<block, label, overlap, containment>>, one row for each row of ``docs``."""
    sets = template_sets(templates, threshold)
    scanned = scratch(scan_texts(docs, sets, phrases, id_col, text_col), "license-blocks")
    # rows that agree in the whole key have the same blocks, whose matches fold into one another
    blocks = scanned.where(F.size("blocks") > 0).select(*KEY, F.inline("blocks"))
    found = match_blocks(blocks, sets).groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.struct("block", "label", "overlap", "containment"))).alias("matches"))
    return join_key(scanned, found).select(F.col("k_id").alias(id_col), "n_words", "hits", "matches")
