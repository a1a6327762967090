from __future__ import annotations

import math
import random

import numpy as np

from tallyspark.llm import linear
from tallyspark.llm import quality_em as qe

SF = "/root/testdata/sf0.01"


def test_em_recovers_accuracies():
    rng = np.random.default_rng(1)
    n, right = 20_000, [0.95, 0.9, 0.8, 0.7, 0.6, 0.85]
    truth = (rng.random(n) < 0.7).astype(int)
    codes = np.zeros(n, np.int64)
    for acc in right:
        vote = np.where(rng.random(n) < acc, truth, 1 - truth)
        codes = codes * 3 + np.where(rng.random(n) < 0.3, 2, vote)
    distinct, counts = np.unique(codes, return_counts=True)
    model = qe.expectation_maximisation(distinct, counts.astype(float), len(right))
    assert abs(model.share - 0.7) < 0.03
    for t, acc in zip(model.table, right, strict=True):
        assert abs(t[1, 1] - acc) < 0.04 and abs(t[0, 0] - acc) < 0.05
    found = model.posterior(codes) >= 0.5
    assert (found == (truth == 1)).mean() > 0.93


def slow_em(codes, counts, n, rounds):
    """The same updates, row by row."""
    rows = [[c // 3 ** (n - 1 - i) % 3 for i in range(n)] for c in codes]
    p = []
    for r in rows:
        b = r.count(0)
        p.append(0.95 if b == 0 else 1 / (1 + 2 * b))
    for _ in range(rounds):
        table = [[[1.0] * 2 for _ in range(2)] for _ in range(n)]
        up = 0.0
        for r, q, k in zip(rows, p, counts, strict=True):
            up += q * k
            for i, v in enumerate(r):
                if v < 2:
                    table[i][1][v] += q * k
                    table[i][0][v] += (1 - q) * k
        table = [[[x / sum(t) for x in t] for t in pair] for pair in table]
        share = (up + 1) / (sum(counts) + 2)
        new = []
        for r in rows:
            a, b = share, 1 - share
            for i, v in enumerate(r):
                if v < 2:
                    a, b = a * table[i][1][v], b * table[i][0][v]
            new.append(a / (a + b))
        p = new
    return p


def test_em_matches_plain_loops():
    rng = np.random.default_rng(2)
    codes = np.unique(rng.integers(0, 3 ** 4, 60))
    counts = rng.integers(1, 50, len(codes)).astype(float)
    model = qe.expectation_maximisation(codes, counts, 4, rounds=7)
    assert np.allclose(model.posterior(codes), slow_em(codes.tolist(), counts, 4, 7), atol=1e-6)


def test_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    out = {r.doc_id: r for r in qe.classify(docs).collect()}
    assert len(out) == docs.count()
    good = [out[i] for i, q in truth.items() if q == 1]
    bad = [out[i] for i, q in truth.items() if q == 0]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)


def test_edge_rows(edge_docs, no_docs):
    out = qe.classify(edge_docs).collect()
    assert len(out) == edge_docs.count()
    assert all(0 <= r.score <= 1 and r.kept == (r.score >= qe.KEEP_AT) for r in out)
    assert len({r.score for r in out if r.doc_id in (3, 4, 5)}) == 1
    assert len({r.score for r in out if r.doc_id == 2}) == 1
    assert qe.classify(no_docs).collect() == []


def slow_fit(rows, dim, classes, iterations, step=4.0, ridge=1e-5):
    """The accelerated gradient steps on dense rows, one row after another."""
    w = [[0.0] * classes for _ in range(dim)]
    ahead, momentum = [list(x) for x in w], 1.0
    total = sum(sum(want) for _, _, want in rows)
    for _ in range(iterations):
        grad = [[0.0] * classes for _ in range(dim)]
        for idx, val, want in rows:
            z = [sum(ahead[i][c] * v for i, v in zip(idx, val)) for c in range(classes)]
            e = [math.exp(x - max(z)) for x in z]
            for c in range(classes):
                off = e[c] / sum(e) * sum(want) - want[c]
                for i, v in zip(idx, val):
                    grad[i][c] += off * v / total
        new = [[a - step * (g + ridge * a) for a, g in zip(x, y)] for x, y in zip(ahead, grad)]
        later = (1 + math.sqrt(1 + 4 * momentum ** 2)) / 2
        ahead = [[n + (momentum - 1) / later * (n - o) for n, o in zip(x, y)]
                 for x, y in zip(new, w)]
        w, momentum = new, later
    return w


def test_fit_matches_plain_loops(spark):
    """Soft labels, rows of unequal weight and length, an empty row, over several partitions."""
    rng = random.Random(6)
    rows = []
    for _ in range(60):
        idx = sorted(rng.sample(range(12), rng.randint(0, 5)))
        val = [rng.uniform(0.2, 1) for _ in idx]
        norm = math.sqrt(sum(v * v for v in val)) or 1.0
        rows.append((idx, [v / norm for v in val], [rng.uniform(0, 2) for _ in range(3)]))
    df = spark.createDataFrame(rows, "idx array<int>, val array<double>, want array<double>")
    for parts in (1, 4):
        got = linear.fit(df.repartition(4), 12, 3, iterations=15, parts=parts)
        assert np.allclose(got, slow_fit(rows, 12, 3, 15), atol=1e-9)
    assert (linear.fit(df.where("false"), 12, 3) == 0).all()


def test_fit_reaches_the_least_loss(spark):
    """The gradient vanishes: no nearby weights are better."""
    rng = random.Random(2)
    rows = [([rng.randrange(4), 4], [0.8, 0.6], rng.choice([[1.0, 0.0], [0.0, 1.0], [0.3, 0.7]]))
            for _ in range(80)]
    df = spark.createDataFrame(rows, "idx array<int>, val array<double>, want array<double>")
    w = linear.fit(df, 5, 2, iterations=200, step=1.0)

    def loss(w):
        out = 0.0
        for idx, val, want in rows:
            z = np.array(val) @ w[idx]
            out -= np.array(want) @ (z - np.log(np.exp(z).sum()))
        return out / sum(sum(x[2]) for x in rows) + 5e-6 * (w ** 2).sum()

    best = loss(w)
    for i in range(5):
        for c in range(2):
            for d in (-0.02, 0.02):
                near = w.copy()
                near[i, c] += d
                assert loss(near) >= best - 1e-7


def test_scores_are_those_of_the_model_row_by_row(spark, edge_docs):
    """``classify`` against the learned model applied in plain Python: votes, posterior of the
    pattern, hashed features, logistic score."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = qe.learn(docs)
    for d in (docs, edge_docs):
        d = d.select("doc_id", "text")
        sent = {}
        for r in d.collect():
            at, val = qe.Hasher(len(model.weights))(r.text)
            z = sum(float(model.weights[i, 1] - model.weights[i, 0]) * float(v)
                    for i, v in zip(at, val))
            sent.setdefault(r.doc_id, []).append((1 / (1 + math.exp(-z)), model.score(at, val)))
        for pairs in sent.values():
            for slow, fast in pairs:
                assert abs(slow - fast) < 1e-6
    got = {r.doc_id: r.score for r in qe.classify(docs).collect()}
    for r in docs.collect():
        assert abs(got[r.doc_id] - model.score(*qe.Hasher(len(model.weights))(r.text))) < 1e-9
