"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a
DataFrame that is written as Parquet and read again before the next one. All but the last return
the columns of ``documents``.

* toxicity: fits the classifier on the labelled rows among the documents and drops what it rejects;
* line_dedup: cuts boilerplate lines that many sources share (no document goes);
* near_dedup: keeps one document of each group of near copies (five-word shingles, similarity 0.8), by id and text;
* mixing: repeats and samples whole documents to the sources' target weights;
* packing: sequences of 4,096 token ids in Hilbert order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsift.llm import linededup, mixing, neardup, packing, toxicity
from flowsift.llm.common import scratch, table
from flowsift.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def cut_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = linededup.clean(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cleaned


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.materialize_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_boilerplate),
    ("near_dedup", keep_one_of_each),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A fitted classifier and a tokenizer have no SQL form; tests/llm/test_pipeline_stages.py compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
