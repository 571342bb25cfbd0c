"""The classifier's fit against a dense reference, and the same model from the same rows however they lie."""

import random

import numpy as np

from flowsift.llm import toxicity


def reference(rows, labels, pairs, size, fairness=4.0, decay=2e-4):
    """Newton's method on the stated loss with dense matrices (the bias is not decayed)."""
    x = np.zeros((len(rows), size + 1))
    x[:, size] = 1
    for i, r in enumerate(rows):
        x[i, r] = 1
    d = np.zeros((len(pairs), size + 1))
    for i, (a, b) in enumerate(pairs):
        np.add.at(d[i], a, 1.0)
        np.add.at(d[i], b, -1.0)
    keep = np.append(np.full(size, decay), 1e-9)
    w = np.zeros(size + 1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        g = x.T @ (p - labels) / len(rows) + keep * w + 2 * fairness * d.T @ (d @ w) / max(len(pairs), 1)
        h = (x * (p * (1 - p))[:, None]).T @ x / len(rows) + np.diag(keep) + 2 * fairness * d.T @ d / max(len(pairs), 1)
        w = w - np.linalg.solve(h, g)
    return w[:size], w[size]


def test_fit_against_newton():
    g = np.random.default_rng(4)
    size, n = 25, 600
    true = g.normal(0, 1.5, size)
    rows = [np.flatnonzero(g.random(size) < 0.3) for _ in range(n)]
    labels = (g.random(n) < 1 / (1 + np.exp(-np.array([true[r].sum() for r in rows])))).astype(float)
    pairs = [(np.array([0, 3]), np.array([1, 3])), (np.array([1]), np.array([2])), (np.array([0]), np.array([2]))]
    w, b = toxicity.fit(rows, labels, pairs, size, steps=3000)
    v, c = reference(rows, labels, pairs, size)
    for r in rows:
        got, want = (1 / (1 + np.exp(-(a[r].sum() + z))) for a, z in ((w, b), (v, c)))
        assert abs(got - want) < 0.01
    assert abs(w[0] - w[1]) < abs(true[0] - true[1]) / 4


def test_same_rows_same_model(spark):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        y = int(i % 5 == 0)
        words = [f"n{r.randrange(80)}" for _ in range(12)] + ["vile"] * y + (["women are here."] if i % 3 == 0 else [])
        rows.append((i, " ".join(words) + "."))
        labels.append((i, y))
    models = []
    for parts in (1, 7):
        docs = spark.createDataFrame(rows if parts == 1 else rows[::-1], "doc_id long, text string").repartition(parts)
        models.append(toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int").repartition(parts), max_sentences=20))
    assert models[0] == models[1] and len(models[0].weights) > len(toxicity.TERMS)
