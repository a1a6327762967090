from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import mixing as mx

SF = "/root/testdata/sf0.01"


def members(spark, p, n):
    cols = [f"p_{i}" for i in range(p.shape[1])]
    rows = [(*map(float, x), int(k)) for x, k in zip(p, n, strict=True)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", n_tokens long")


def soft(rng, n):
    p = rng.dirichlet([0.3, 0.2, 0.1], n)
    return mx._rounded(p)


def plain_descent(p, n, want, steps=60_000):
    """Projected gradient descent on every rate in memory, from ones: the brute force."""
    r, whole = np.ones(len(p)), n.sum()
    scale = 1 / np.maximum(n @ p / whole, 1e-3)
    for _ in range(steps):
        r = np.maximum(0, r - 0.9 * p @ (scale * ((r * n) @ p / whole - want)))
    return r


@pytest.mark.parametrize("want", [(0.5, 0.3, 0.2), (0.95, 0.04, 0.01), (0.1, 0.1, 0.8)])
def test_rates_meet_targets(spark, want):
    rng = np.random.default_rng(4)
    p, n = soft(rng, 300), rng.integers(0, 500, 300)
    pull = mx.fit_rates(members(spark, p, n), dict(zip("abc", want, strict=True)))
    r = mx.rates(p, pull)
    assert (r >= 0).all()
    assert np.abs((r * n) @ p / n.sum() - np.array(want)).max() <= 1e-3
    slow = plain_descent(p, n, np.array(want))
    assert np.abs((slow * n) @ p / n.sum() - np.array(want)).max() <= 1e-3
    # of all rates that meet the targets, those nearest to one
    assert (n * (r - 1) ** 2).sum() <= (n * (slow - 1) ** 2).sum() * 1.02 + 1e-6


def test_domains_hard_to_tell_apart(spark):
    p = np.array([[0.8, 0.1, 0.1], [0.79, 0.11, 0.1], [0.8, 0.11, 0.09], [0.81, 0.1, 0.09]])
    n = np.array([40, 30, 20, 10])
    want = (n * np.array([0.9, 1.3, 0.8, 1.1])) @ p / n.sum()
    pull = mx.fit_rates(members(spark, p, n), dict(zip("abc", want / want.sum(), strict=True)),
                        budget=want.sum())
    assert np.abs((mx.rates(p, pull) * n) @ p / n.sum() - want).max() <= 1e-3


def test_unreachable_target_ends_at_least_squares(spark):
    p = np.tile([[1.0, 0.0, 0.0]], (20, 1))
    pull = mx.fit_rates(members(spark, p, np.full(20, 10)), {"a": 0.5, "b": 0.5, "c": 0.0})
    assert np.allclose(mx.rates(p, pull), 0.5, atol=1e-3)


def test_documents_meet_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = mx.mix(docs, labels)
    assert out.columns == ["doc_id", "n_tokens", "p_clean", "p_junk", "p_toxic", "rate", "copies"]
    rows = out.collect()
    assert len(rows) == docs.count()
    whole = sum(r.n_tokens for r in rows)
    for d, t in mx.TARGETS.items():
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in rows) / whole - t) < 2e-3
    truth = {r.doc_id: r.domain for r in mx.domains_of(labels).collect()}
    right = [max(mx.TARGETS, key=lambda d: r[f"p_{d}"]) == truth[r.doc_id]
             for r in rows if r.doc_id in truth]
    assert sum(right) >= 0.9 * len(right)
    assert all(np.floor(r.rate) <= r.copies <= np.ceil(r.rate) for r in rows)
    mixed = mx.mixed_documents(docs, labels)
    assert mixed.columns == docs.columns
    copies = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert copies == {r.doc_id: r.copies for r in rows if r.copies}


def test_edge_rows(spark, edge_docs, no_docs, labels):
    for lab in (labels, labels.where("false"), labels.where("toxic = 1"),
                labels.withColumn("toxic", F.lit(None).cast("int"))):
        out = mx.mix(edge_docs, lab).collect()
        assert len(out) == edge_docs.count()
        assert all(r.rate >= 0 for r in out)
        assert all(abs(r.p_clean + r.p_junk + r.p_toxic - 1) < 1e-9 for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (3, 4, 5)} == {0}
    assert mx.mix(no_docs, labels).collect() == []
    assert mx.mixed_documents(no_docs, labels).collect() == []
    assert mx.mixed_documents(edge_docs, labels).columns == edge_docs.columns


def test_unsettled_steps_are_reported(spark, recwarn):
    rng = np.random.default_rng(4)
    p, n = soft(rng, 300), rng.integers(0, 500, 300)
    want = {"a": 0.1, "b": 0.1, "c": 0.8}
    with pytest.warns(RuntimeWarning, match=r"did not settle in 1 steps.*a [+-].*b [+-].*c [+-]"):
        mx.fit_rates(members(spark, p, n), want, max_steps=1)
    recwarn.clear()
    mx.fit_rates(members(spark, p, n), want)
    assert not [w for w in recwarn if "did not settle" in str(w.message)]
