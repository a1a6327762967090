from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from tallyspark.llm import periodic_runs as pr


def brute(words):
    """Every period at every place, one word after another."""
    n, out = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_text(rng):
    """Words from small or large vocabularies with blocks repeated here and there."""
    words = []
    while len(words) < rng.randint(0, 220):
        alphabet = rng.choice([1, 2, 3, 30, 500])
        block = [f"w{rng.randrange(alphabet)}" for _ in range(rng.randint(1, 30))]
        words += block * rng.choice([1, 1, 2, 3, 4, 9])
        if rng.random() < 0.3:
            words += block[:rng.randrange(len(block) + 1)]
        if rng.random() < 0.2 and words:
            words[rng.randrange(len(words))] = "odd"
    return words


def test_random_texts_against_brute_force():
    rng, seen = random.Random(7), 0
    for _ in range(1500):
        words = some_text(rng)
        runs = pr.runs_of(words)
        assert runs == brute(words), words
        assert pr.collapsed(words, runs) == kept(words, runs)
        seen += len(runs)
    assert seen > 500


@pytest.mark.parametrize("n,q", [(23, 1), (24, 1), (24, 8), (24, 9), (26, 9), (27, 9), (600, 7),
                                 (5000, 1), (5000, 1600), (5000, 1667)])
def test_bounds_of_one_run(n, q):
    words = [f"b{i % q}" for i in range(n)]
    want = [(3, n, q)] if n >= max(24, 3 * q) else []
    assert pr.runs_of(["x", "y", "z", *words, "end"]) == want


def test_no_rare_word_survives_in_a_segment():
    import numpy as np
    words = np.array([1, 2, 3] * 20 + [9] + [4, 5] * 30 + [1, 1, 7, 8, 6] * 2)
    for s, e in pr.segments(words):
        assert e - s >= 24 and min(np.bincount(words[s:e])[words[s:e]]) >= 3
    assert pr.segments(words) == [(0, 60), (61, 121)]


def expected(doc_id, text):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = pr.runs_of(words) if n > 400 else brute(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (doc_id, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept(words, runs).encode()).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
           "collapsed_sha256"]


def test_documents_and_edge_rows(spark, docs, edge_docs, no_docs):
    for d in (docs, edge_docs):
        rows = pr.run_digests(d).select(*COLUMNS).collect()
        want = [expected(r.doc_id, r.text) for r in d.collect()]
        assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
        assert d is edge_docs or any(r["n_runs"] for r in rows)
    assert pr.run_digests(no_docs).collect() == []


def test_runs_and_texts(spark):
    text = "a b c " + "x y " * 20 + "end"
    d = spark.createDataFrame([(5, text, "mine")], "doc_id int, text string, runs string")
    row = pr.periodic_runs(d).first()
    assert [tuple(r) for r in row["runs"]] == [(3, 40, 2)]
    assert row["collapsed_text"] == "a b c x y end"


def test_very_long_text_of_one_word_and_of_two_scales():
    assert pr.runs_of(["a"] * 120_000) == [(0, 120_000, 1)]
    inner = ["a", "b"] * 30 + ["c"]
    runs = pr.runs_of(inner * 200)
    assert (0, 61 * 200, 61) in runs and len(runs) == 201
