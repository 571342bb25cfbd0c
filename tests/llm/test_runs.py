"""Periodic runs against all periods of all stretches, and the defined cases."""

import random
import time

import duckdb

from flowsift.llm import runs
from flowsift.llm.queries import QUERIES
from flowsift.llm.sql import ORACLE

SCHEMA = "doc_id long, text string, runs string, n_words long"


def brute(w: list, shortest: int) -> list[tuple[int, int, int]]:
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            s, e = i, j + q
            if j > i and e - s >= max(shortest, 2 * q) and not any(
                    all(w[x] == w[x + p] for x in range(s, e - p)) for p in range(1, q)):
                out.append((s, e - s, q))
            i = max(j, i + 1)
    return sorted(out)


def texts(seed: int, n: int) -> list[list[str]]:
    r = random.Random(seed)
    out = []
    for _ in range(n):
        words = [f"w{r.randrange(r.choice([1, 2, 3, 9, 40]))}" for _ in range(r.randint(0, 70))]
        if words and r.random() < 0.6:
            p = r.randint(1, 9)
            words = words[: r.randint(0, len(words))] + (words[:p] * 20)[: r.randint(0, 60)] + words
        out.append(words)
    return out


def test_against_brute_force(spark):
    t = texts(3, 300)
    docs = spark.createDataFrame([(i, "\n".join(w)) for i, w in enumerate(t)], "doc_id long, text string")
    for shortest in (2, 12):
        for r in runs.find_runs(docs, shortest).collect():
            w = t[r.doc_id]
            want = brute(w, shortest)
            assert [tuple(x) for x in r.runs] == want and r.n_words == len(w)
            gone = {i for s, n, q in want for i in range(s + q, s + n)}
            assert r.collapsed == " ".join(v for i, v in enumerate(w) if i not in gone)


def test_suffix_array():
    import numpy as np

    s = np.array([2, 1, 2, 1, 2, 1, 1, 9])
    sa, isa, ranks = runs.suffix_array(s)
    assert sa.tolist() == sorted(range(8), key=lambda i: s[i:].tolist()) and (isa[sa] == np.arange(8)).all()
    lcp = runs.common_prefixes(sa, ranks)
    for k in range(1, 8):
        a, b = s[sa[k - 1]:].tolist(), s[sa[k]:].tolist()
        assert lcp[k] == next(i for i, (x, y) in enumerate(zip(a + [-1], b + [-2])) if x != y)


def test_long_texts_take_linear_memory_and_little_time():
    fib = [[b"a"], [b"b", b"a"]]
    while len(fib[-1]) < 60_000:
        fib.append(fib[-1] + fib[-2])
    t0 = time.time()
    for words, n in (([b"x"] * 300_000, 1), ([b"a", b"b", b"c"] * 100_000, 1), (fib[-1], None)):
        found, kept = runs._block([words], 12)
        assert n is None or (len(found[0]) == n and len(kept[0].split()) <= 3)
    assert len(found[0]) > 10_000 and time.time() - t0 < 60


def test_odd_rows(spark):
    rows = [(1, None, "r", 7), (2, "", None, None), (None, "a " * 30, "r", 7), (4, " \t\n ", "r", 7), (5, "b c " * 9, "r", 7), (5, "b c " * 9, "r", 7)]
    got = sorted(map(tuple, runs.find_runs(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == sorted([(1, 0, [], ""), (2, 0, [], ""), (4, 0, [], ""), (None, 30, [(0, 30, 1)], "a"),
                          (5, 18, [(0, 18, 2)], "b c"), (5, 18, [(0, 18, 2)], "b c")], key=str)
    assert runs.find_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_equals_sql_on_odd_rows(spark, tmp_path):
    """Rows with every remainder of the planting rule, beside the driver's tables."""
    t = texts(9, 400)
    rows = [(i, None if i % 37 == 0 else " ".join(w)) for i, w in enumerate(t)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = QUERIES["op12_runs"](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE['op12_runs']})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in want) > 50
