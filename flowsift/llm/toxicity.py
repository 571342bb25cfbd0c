"""Counterfactual-regularised toxicity classifier.

A logistic model over the presence of words. Words are chosen and weights fitted on a bounded
sample of labelled rows (``max_rows``); scoring covers every whole text. Sentences that mention a
group are paired with copies in which the identity term is swapped for another; the loss adds the
squared change of the model's logit over those pairs, so that the mention itself carries no score
and neutral mentions are not taken for insults. Neutral carrier sentences are paired in the same
way, which ties the terms together even where the labelled rows hold few of them.

Defined cases: null and empty texts are scored like a text without known words; rows without a
label or an id train nothing; repeated rows are scored alike; very long texts are read whole; without
labelled rows of both kinds every score is the base rate; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch, shipped

MAX_ROWS = 16_384
MAX_WORDS = 2_048
MAX_SENTENCES = 2_048
MIN_ROWS = 4
MIN_Z = 4.0
THRESHOLD = 0.7

# Identity terms by language, each list interchangeable.
IDENTITY = {
    "en": ["women", "men", "muslims", "christians", "jews", "gays", "immigrants", "blacks", "whites", "asians", "disabled", "elderly"],
    "de": ["frauen", "männer", "muslime", "christen", "juden", "schwule", "einwanderer", "behinderte"],
    "fr": ["femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "handicapés"],
    "es": ["mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "discapacitados"],
}
TERMS = {t: terms for terms in IDENTITY.values() for t in terms}
CARRIERS = ["my neighbours are {}", "the report is about {}", "{} live in this town"]

#: ASCII characters that are no letters become spaces.
TABLE = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def word_set(text: str | None) -> set[bytes]:
    """Distinct lower-case words of a text."""
    return set(text.lower().encode("utf-8", "replace").translate(TABLE).split()) if text else set()


def held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 3 == 1


@dataclass
class Model:
    weights: dict[bytes, float]
    bias: float

    def score(self, text: str | None) -> float:
        z = self.bias + sum(self.weights[w] for w in word_set(text) & self.weights.keys())
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def counterfactuals(sentence: set[bytes]) -> list[set[bytes]]:
    """The sentence's words with each identity term swapped for the next two of its list."""
    out = []
    for term, terms in TERMS.items():
        t = term.encode()
        if t in sentence:
            at = terms.index(term)
            out += [(sentence - {t}) | {terms[(at + k) % len(terms)].encode()} for k in (1, 2)]
    return out


def fit(rows: list[np.ndarray], labels: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], size: int,
        fairness: float = 4.0, decay: float = 2e-4, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights by accelerated gradient descent on log loss + decay |w|^2 + fairness * mean (change)^2."""
    index = np.concatenate([*rows, np.empty(0, int)]).astype(int)
    lengths = np.array([len(r) for r in rows])
    owner = np.repeat(np.arange(len(rows)), lengths)
    w, bias = np.zeros(size), math.log((labels.mean() + 1e-6) / (1 - labels.mean() + 1e-6))
    swap = np.zeros((len(pairs), size))
    for i, (a, b) in enumerate(pairs):
        np.add.at(swap[i], a, 1.0)
        np.add.at(swap[i], b, -1.0)
    step = np.zeros(size)
    look, past, momentum = w, w, 1.0
    # curvature of each weight, for a step of its own
    curve = 0.25 * np.bincount(index, minlength=size) / len(rows) * max(1.0, float(np.median(lengths)) or 1.0) + decay
    curve += 4 * fairness * (swap ** 2).mean(axis=0) if len(pairs) else 0
    for _ in range(steps):
        z = np.bincount(owner, weights=look[index], minlength=len(rows)) + bias
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels
        step = np.bincount(index, weights=error[owner], minlength=size) / len(rows) + decay * look
        if len(pairs):
            step = step + 2 * fairness * swap.T @ (swap @ look) / len(pairs)
        w, past = look - step / curve, w
        bias -= 2.0 * float(error.mean())
        momentum, last = (1 + math.sqrt(1 + 4 * momentum ** 2)) / 2, momentum
        look = w + (last - 1) / momentum * (w - past)
    return w, bias


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_words: int = MAX_WORDS,
          max_sentences: int = MAX_SENTENCES, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """Fits on at most about ``max_rows`` labelled rows outside the held-out third, chosen by a hash
    of their id, over the ``max_words`` most telling words and the terms. Pairs come from the
    ``max_sentences`` mentioning sentences of those rows that have the smallest hash, so the same rows give
    the same model however they lie. The driver receives known words and those sentences only."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    share = min(1.0, max_rows / max(known.count(), 1))
    known = known.where(F.shiftrightunsigned(F.xxhash64("id"), 11) < int(share * (1 << 53)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ws, sentences = [], []
            for text in b.column(1).to_pylist():
                ws.append([w.decode() for w in word_set(text)])
                mention = re.split(r"[.!?\n]+", text or "") if any(t in (text or "").lower() for t in TERMS) else []
                own = [word_set(x) for x in mention]
                sentences.append([" ".join(sorted(w.decode() for w in x)) for x in own if any(t.encode() in x for t in TERMS)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ws, pa.list_(pa.string())), pa.array(sentences, pa.list_(pa.string()))],
                                             ["y", "ws", "sentences"])

    d = shipped(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = d.join(known, "id").select("y", "text").mapInArrow(read, "y int, ws array<string>, sentences array<string>")
    sample = scratch(sample, "toxic-sample")
    n, toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not n or not toxic or toxic == n:
        return Model({}, math.log((toxic + 0.5) / (n - toxic + 0.5)))
    rate = toxic / n
    # words whose share of toxic rows departs from the base rate, most telling first
    seen = sample.select("y", F.explode("ws").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("c"), F.sum("y").alias("t"))
    z = (F.col("t") - F.col("c") * rate) / F.sqrt(F.col("c") * rate * (1 - rate))
    chosen = seen.where(F.col("c") >= MIN_ROWS).withColumn("z", z).where(F.abs("z") >= MIN_Z)
    words = {r.w for r in chosen.orderBy(F.abs("z").desc(), "w").limit(max_words).collect()} | TERMS.keys()
    vocabulary = {w: i for i, w in enumerate(sorted(words))}
    mine = F.array_intersect("ws", F.array(*[F.lit(w) for w in vocabulary]))
    rows = sample.select("y", F.array_sort(mine).alias("ws")).toPandas()
    rows = rows.iloc[np.argsort(np.array([f"{y} {' '.join(ws)}" for y, ws in zip(rows["y"], rows["ws"])]), kind="stable")]
    drawn = sample.select(F.explode("sentences").alias("s")).distinct().orderBy(F.xxhash64("s"), "s").limit(max_sentences)
    place = lambda ws: np.array(sorted(vocabulary[w] for w in ws if w in vocabulary), dtype=int)
    sentences = sorted(r.s for r in drawn.collect()) + [c.format(t) for c in CARRIERS for t in TERMS]
    pairs = []
    for s in sentences:
        own = word_set(s)
        pairs += [(place({w.decode() for w in own}), place({w.decode() for w in x})) for x in counterfactuals(own)]
    w, bias = fit([place(x) for x in rows["ws"]], rows["y"].to_numpy(dtype=float), pairs, len(vocabulary))
    return Model({k.encode(): float(w[i]) for k, i in vocabulary.items()}, float(bias))


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the model's score of every whole text."""
    shipped(docs)

    @F.pandas_udf("double")
    def scores(texts):
        return texts.map(lambda x: model.score(x if isinstance(x, str) else None))

    return docs.withColumn(out, scores(F.col(text_col).cast("string")))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text_col: str = "text", **settings) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    model = train(docs, labels, text_col=text_col, **settings)
    return score(docs, model, text_col, "__toxic").where(F.col("__toxic") < threshold).drop("__toxic")
