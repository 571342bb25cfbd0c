"""Every stage of the pipeline against brute force, each on what its predecessor kept."""

import random

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from flowsift.llm import mixing, toxicity
from flowsift.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    r = random.Random(12)
    vocabulary = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(240):
        words = r.choices(vocabulary, k=r.randint(30, 60))
        toxic = i % 5 == 0
        if toxic:
            words[3], words[9] = "vile", "scum"
        if rows and r.random() < 0.25:  # a near copy
            words = r.choice(rows)[1].split("\n")[0].split()
            words[r.randrange(len(words))] = "changed"
            toxic = "vile" in words
        text = " ".join(words) + ("\nshared banner of the site" if r.random() < 0.5 else "")
        rows.append((i, text, "en", None if i % 29 == 0 else f"s{i % 11}", len(text)))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def shingles(text):
    w = text.lower().split()
    return {tuple(w[p:p + 5]) for p in range(max(1, len(w) - 4))} if w else set()


def test_stages(spark, tmp_path):
    rows, labels = corpus()
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(rows, SCHEMA)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]

    def after(name, docs):
        out = stages[name](spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    texts = {r[0]: r[1] for r in rows}
    model = toxicity.train(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    kept = after("toxicity", docs)
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {i for i, t in texts.items() if model.score(t) < 0.7}
    assert all(i not in ids for i, t in texts.items() if "vile" in t.split()) and len(ids) > 150

    sites: dict = {}
    known = {r.doc_id: r for r in kept.collect()}
    for r in known.values():
        for line in r.text.split("\n"):
            sites.setdefault(line.strip(), set()).add(r.source)
    cleaned = after("line_dedup", kept)
    for r in cleaned.collect():
        lines = known[r.doc_id].text.split("\n")
        own = [x for x in lines if len(sites[x.strip()]) < 8]
        assert r.text == "\n".join(own if own else lines) and r.n_chars == len(r.text)

    sets = {r.doc_id: shingles(r.text) for r in cleaned.collect()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    single = after("near_dedup", cleaned)
    assert {r.doc_id for r in single.collect()} == {find(i) for i in sets} and len({find(i) for i in sets}) < len(sets)

    targets = {r.source: r.target for r in mixing.mix(single).collect()}
    mixed = after("mixing", single)
    size = F.size(F.split(F.trim("text"), r"\s+"))
    got = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(size).alias("n")).collect()}
    assert all(abs(got.get(s, 0) - t) <= 60 for s, t in targets.items())
    times = [r["count"] for r in mixed.groupBy("doc_id").count().collect()]
    assert max(times) <= 2
    again = stages["mixing"](spark, single.repartition(5), str(tmp_path))
    assert again.exceptAll(mixed).count() == 0 and mixed.exceptAll(again).count() == 0

    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = sorted(stages["packing"](spark, mixed, str(tmp_path)).collect(), key=lambda p: (p.sequence_id, p.offset))
    assert [p.sequence_id * 4096 + p.offset for p in pieces] == list(np.cumsum([0] + [p.length for p in pieces])[:-1])
    stream = np.frombuffer(b"".join(bytes(p.ids) for p in pieces), dtype="<u4").tolist()
    packed, one = [], []
    for t in stream:
        one.append(t)
        if t == 2:
            packed.append(one)
            one = []
    want = [tokenizer.encode(r.text, add_special_tokens=False).ids + [2] for r in mixed.collect()]
    assert sorted(packed) == sorted(want)
