from __future__ import annotations

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import toxicity_knn as tk

SF = "/root/testdata/sf0.1"


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


@pytest.mark.parametrize("seed", range(4))
def test_search_is_exact(seed):
    rng = np.random.default_rng(seed)
    n, v, k = 700, 60, 15
    m = rng.random((n, v)) * (rng.random((n, v)) < 0.08)
    m[rng.integers(0, n, 90)] = m[3]  # ties
    m = (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    vocab = {f"t{i}": i for i in range(v)}
    index = tk.BlockMaxIndex(vocab, np.ones(v), m, np.zeros(n), np.ones(n), list(range(n)), 16)
    skipped = 0
    for _ in range(60):
        words = [f"t{i}" for i in rng.integers(0, v + 5, rng.integers(0, 12))]
        at, w = index.vector(words)
        where, cos, opened = index.search(at, w, k)
        every = index.examples[:, at] @ w if len(at) else np.zeros(n)
        best = np.lexsort((np.arange(n), -every))[:k]
        best = best[every[best] > 0]
        assert np.allclose(cos, every[best], atol=1e-5)
        assert len(where) == len(best)
        assert (every[where] >= (every[best].min() if len(best) else 0) - 1e-5).all()
        skipped += index.maxima.shape[1] - opened
    assert skipped > 0  # bounds did prune


def auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = {r.doc_id: r for r in tk.score_documents(docs, labels).collect()}
    assert len(out) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    for i, r in out.items():
        assert r.held_out == (fold(i) == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert all(fold(j) != 0 for j in r.neighbours)
    test = [(out[i].score, y) for i, y in truth.items() if fold(i) == 0]
    assert auc(test) >= 0.9
    assert sum((s >= 0.5) == (y == 1) for s, y in test) >= 0.9 * len(test)


def test_held_out_labels_do_not_matter(spark, docs, labels):
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast(
        "binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = sorted(map(tuple, tk.score_documents(docs, labels).collect()))
    assert a == sorted(map(tuple, tk.score_documents(docs, turned).collect()))


def test_edge_rows(spark, edge_docs, no_docs, labels):
    out = tk.score_documents(edge_docs, labels).collect()
    assert len(out) == edge_docs.count()
    assert len({r.score for r in out if r.doc_id in (3, 4, 5)}) == 1
    assert all(r.held_out is None for r in out if r.doc_id is None)
    assert tk.score_documents(no_docs, labels).collect() == []
    for lab in (labels.where("false"), labels.where("toxic = 0"),
                spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")):
        assert all(0 <= r.score <= 1 for r in tk.score_documents(edge_docs, lab).collect())


def test_copies_without_a_telling_word_are_found(spark):
    """Every labelled row is an example with all its terms, however rare they are."""
    rng = np.random.default_rng(7)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 7))
    common = [word() for _ in range(40)]
    texts = {i: " ".join([*rng.choice(common, 20), *(word() for _ in range(6))])
             for i in range(120)}
    copies = {1000 + i: t + " " + word() for i, t in texts.items()}
    docs = spark.createDataFrame(list((texts | copies).items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in texts],
                                   "doc_id long, toxic int")
    out = tk.score_documents(docs, labels)
    rows = {r.doc_id: r for r in out.collect()}
    learned = [i for i in texts if fold(i) != 0]
    for i in learned:
        assert rows[i].neighbours[0] == i and abs(rows[i].cosines[0] - 1) < 1e-5
        assert rows[1000 + i].neighbours[0] == i
    toxic = [rows[1000 + i].score for i in learned if i % 4 == 0]
    assert min(toxic) > max(rows[1000 + i].score for i in learned if i % 4)
    assert tk.share_without_neighbours(out) == 0.0


def test_postings_need_no_small_vocabulary():
    """Lists by term hold the weights above zero only; a large vocabulary takes no matrix."""
    rng = np.random.default_rng(2)
    n, v = 400, 300_000
    rows = []
    for _ in range(n):
        at = np.unique(np.append(rng.integers(3, v, 30), rng.integers(0, 3, 2))).astype(np.int32)
        w = rng.random(len(at)).astype(np.float32)
        rows.append((at, w / np.linalg.norm(w)))
    index = tk.BlockMaxIndex({}, np.ones(v), tk.Sparse.of(rows), np.zeros(n), np.ones(n),
                             list(range(n)), 16)
    assert len(index.postings.at) == sum(len(at) for at, _ in rows)
    assert index.full.shape == (n, 3)
    for i, (at, w) in enumerate(rows[:40]):
        where, cos, _ = index.search(at, w)
        every = np.array([w @ [dict(zip(*e, strict=True)).get(t, 0.0) for t in at] for e in rows])
        assert index.ids[where[0]] == i
        assert np.allclose(cos, np.sort(every)[::-1][:len(cos)], atol=1e-5)


def test_evidence_adds_up_over_short_and_long_lists():
    """Cosines and evidence are those of whole rows, of the lists by posting and of those in
    full rows, and a query's are the same to the last bit whatever it is searched with."""
    rng = np.random.default_rng(5)
    n, v = 300, 500
    rows = []
    for _ in range(n):
        at = np.unique(np.append(rng.integers(20, v, 15), rng.integers(0, 20, 9))).astype(np.int32)
        w = rng.random(len(at)).astype(np.float32)
        rows.append((at, w / np.linalg.norm(w)))
    evidence = rng.random(v) + 0.05
    index = tk.BlockMaxIndex({}, np.ones(v), tk.Sparse.of(rows), np.zeros(n), np.ones(n),
                             list(range(n)), 16, evidence=evidence)
    assert 0 < index.full.shape[1] < v
    assert np.allclose(index.telling, index.full * evidence[index.column >= 0])
    x = index.examples.astype(float)
    together = index.evident_search(rows, 20)
    for (at, w), (where, cos, _, told) in zip(rows, together, strict=True):
        assert np.allclose(cos, np.sort(x[:, at] @ w)[::-1][:20], atol=1e-6)
        assert np.allclose(told, x[where][:, at] @ (w * evidence[at]), atol=1e-6)
        alone = index.evident_search([(at, w)], 20)[0]
        assert np.array_equal(alone[0], where)
        assert np.array_equal(alone[1], cos) and np.array_equal(alone[3], told)


def plain_examples(docs, labels):
    """Weights, evidence and examples of the whole labelled table in plain Python."""
    rows = [(r.doc_id, tk.terms(r.text)) for r in docs.collect()]
    df = collections.Counter(t for _, ts in rows for t in set(ts))
    n_rows = len(rows)
    truth = {}
    for r in labels.collect():
        if r.doc_id is not None and r.toxic is not None and fold(r.doc_id):
            truth[r.doc_id] = max(r.toxic, truth.get(r.doc_id, 0))
    learned = {i: ts for i, ts in rows if i in truth}
    n1 = sum(truth[i] for i in learned)
    n0 = len(learned) - n1
    with_t = collections.Counter((t, truth[i]) for i, ts in learned.items() for t in set(ts))
    idf, evidence = {}, {}
    for t in {t for t, _ in with_t}:
        a, b = with_t[t, 1], with_t[t, 0]
        n = n0 + n1
        chi2 = n * (a * (n0 - b) - b * (n1 - a)) ** 2 / (
            n0 * n1 * (a + b) * (n - a - b + 1e-9))
        idf[t] = math.log((2 + n_rows) / (1 + df[t]))
        evidence[t] = tk.LEAST_EVIDENCE + math.log1p(chi2) ** 2
    unseen = math.log((2 + n_rows) / (1 + n_rows / (n0 + n1)))

    def vector(ts):
        w = {t: (1 + math.log(c)) * idf.get(t, unseen)
             for t, c in collections.Counter(ts).items()}
        norm = math.sqrt(sum(x * x for x in w.values())) or 1.0
        return {t: x / norm for t, x in w.items() if t in idf}

    prior = sum(truth.values()) / len(truth)
    merged = {}
    for i, ts in learned.items():
        m = merged.setdefault(tuple(sorted(collections.Counter(ts).items())), [ts, 0, 0])
        m[1 + (truth[i] == 0)] += 1
    w1, w0 = prior / n1, (1 - prior) / n0
    examples = [(vector(ts), a * w1 / (a * w1 + b * w0), 1 + math.log(a + b))
                for ts, a, b in merged.values()]
    return vector, evidence, examples, prior


def test_weights_and_votes_match_plain_python(docs, labels):
    model = tk.learn(docs, labels)
    vector, evidence, examples, prior = plain_examples(docs, labels)
    assert abs(model.prior - prior) < 1e-9 and model.index.size == len(examples)
    compared = 0
    for r in docs.collect():
        at, w = model.index.vector(tk.terms(r.text))
        where, cos, _, told = model.index.evident_search([(at, w)])[0]
        q = vector(tk.terms(r.text))
        every = sorted(((sum(x * e.get(t, 0.0) for t, x in q.items()),
                         sum(x * e.get(t, 0.0) * evidence[t] for t, x in q.items()), y, m)
                        for e, y, m in examples), key=lambda x: -x[0])
        top = [x for x in every[:tk.NEIGHBOURS] if x[0] > 1e-7]
        assert np.allclose(cos[:len(top)], [x[0] for x in top], atol=1e-4)
        if len(every) > tk.NEIGHBOURS and every[tk.NEIGHBOURS - 1][0] - every[
                tk.NEIGHBOURS][0] < 1e-5:
            continue        # a tie at the last neighbour
        near = [x[1] ** 2 * x[3] for x in top]
        slow = (sum(n * x[2] for n, x in zip(near, top)) + tk.PRIOR_WEIGHT * prior) / (
            sum(near) + tk.PRIOR_WEIGHT)
        assert abs(model.index.vote(where, told, model.prior) - slow) < 1e-3
        compared += 1
    assert compared > 100


def test_calibration_is_the_least_loss():
    rng = np.random.default_rng(3)
    votes = rng.random(300)
    y = (rng.random(300) < votes ** 2).astype(int)
    weight = rng.uniform(0.5, 2, 300)
    slope, shift = tk.calibrate(votes, y, weight)
    z = np.log((votes + 1e-3) / (1 - votes + 1e-3))
    up, down = weight[y == 1].sum(), weight[y == 0].sum()
    want = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))

    def loss(a, b):
        p = 1 / (1 + np.exp(-(a * z + b)))
        return -(weight * (want * np.log(p) + (1 - want) * np.log(1 - p))).sum() + 5e-4 * (
            (a - 1) ** 2 + b * b)

    for da in (-0.01, 0, 0.01):
        for db in (-0.01, 0, 0.01):
            assert loss(slope + da, shift + db) >= loss(slope, shift) - 1e-9
