from __future__ import annotations

import hashlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyspark.llm import order_minhash as om


def slow_numbered(text, k=om.K):
    points = om.code_points(text)
    if not len(points):
        return []
    k = min(k, len(points))
    single = {}
    seen, out = {}, []
    for i in range(len(points) - k + 1):
        g = tuple(points[i:i + k].tolist())
        seen[g] = seen.get(g, -1) + 1
        out.append((g, seen[g]))
        single[(g, seen[g])] = i
    return out


def slow_signature(text):
    """By whole lists: of each component the least k-mers, put back in text order."""
    kmers = om.numbered_kmers(om.code_points(text))
    if not len(kmers):
        return [0] * om.COMPONENTS
    out = []
    for c in range(om.COMPONENTS):
        ranks = [((int(x) ^ int(om._XOR[c])) * int(om._MUL[c])) % (1 << 32) for x in kmers]
        least = sorted(range(len(ranks)), key=lambda i: (ranks[i], i))[:om.PICKED]
        v = np.full(1, len(least), np.uint32)
        for j, i in enumerate(sorted(least)):
            v = om._mix((v ^ kmers[i:i + 1]) * np.uint32(0x9E3779B1) + np.uint32(j))
        out.append(int(v[0]))
    return out


TEXTS = ["", "a", "abc", "abcdefg", "aaaaaaaaaaaa", "the cat sat on the cat sat on the cat",
         "é" * 9, "👍🏽 x 👍🏽 x 👍🏽", " ".join(f"w{i % 50}" for i in range(2500))]


@pytest.mark.parametrize("text", TEXTS)
def test_signature_matches_brute_force(text):
    kmers = om.numbered_kmers(om.code_points(text))
    slow = slow_numbered(text)
    assert len(kmers) == len(slow)
    # equal hashes exactly where k-mer and occurrence number are equal
    assert len(set(kmers.tolist())) == len(set(slow))
    assert om.signature(om.code_points(text)).tolist() == slow_signature(text)


def test_chunks_do_not_matter(monkeypatch):
    points = om.code_points(TEXTS[-1])
    whole = om.signature(points)
    monkeypatch.setattr(om, "CHUNK", 100)
    assert (om.signature(points) == whole).all()


def test_likeness_follows_edits_and_order():
    a = " ".join(f"term{i * 7 % 400}" for i in range(400))
    words = a.split()
    sig = {n: om.signature(om.code_points(t)) for n, t in {
        "same": a, "one": a.replace("term70 ", "xxxx "), "half": a[:len(a) // 2] + "q" * 900,
        "shuffled": " ".join(words[200:] + words[:200]), "other": " ".join(
            f"word{i}" for i in range(400))}.items()}
    near = {n: om.likeness(sig["same"], s) for n, s in sig.items()}
    assert near["same"] == 1 and near["one"] > 0.8 > near["half"] > near["other"]
    assert near["shuffled"] < near["one"]  # plain MinHash would call these alike


def turn(text):
    """Rows of one id follow each other by Spark's hash of the text."""
    h = xxhash.xxh64_intdigest((text or "").encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def slow_rows(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, turn(r[1])))
    out = []
    for at, (doc_id, text) in enumerate(rows):
        text, nxt = text or "", rows[(at + 1) % len(rows)][1] or ""
        half = len(text) // 2
        new = text[:len(text) - half] + nxt[:half]
        sigs = [om.signature(om.code_points(t)) for t in (text, new, nxt)]
        out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(),
                    om.to_hex(sigs[0]), om.to_hex(sigs[1]), om.likeness(*sigs[:2]),
                    om.likeness(sigs[0], sigs[2])))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [om.BUCKET_BYTES, 30_000, 2_000])
def test_documents_and_edge_rows(docs, edge_docs, size):
    for d in (docs, edge_docs):
        rows = [(r.doc_id, r.text) for r in d.collect()]
        out = om.edit_neighbours(d, bucket_bytes=size).collect()
        assert sorted(map(tuple, out), key=str) == slow_rows(rows)


def test_hot_ids_spread_over_ranges(spark):
    """One id holds most rows; some of them are equal. No range is much larger than asked for
    (but for equal rows), and every row still finds its successor."""
    rows = [(7, f"text number {i} " * 5) for i in range(300)] + [(7, "the same text " * 6)] * 30
    rows += [(i, f"own {i} " * 12) for i in range(40)] + [(None, f"lone {i} " * 12)
                                                          for i in range(60)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out = om.edit_neighbours(d, bucket_bytes=1_000)
    assert sorted(map(tuple, out.collect()), key=str) == slow_rows(rows)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(
        F.sum("n_chars").alias("n")).collect()]
    assert len(sizes) > 20 and max(sizes) < 6_000


def test_ranges_are_tasks_and_even_in_bytes(docs):
    out = om.edit_neighbours(docs, bucket_bytes=20_000)
    sizes = sorted(r["n"] for r in out.groupBy(F.spark_partition_id()).agg(
        F.sum("n_chars").alias("n")).collect())
    longest = docs.agg(F.max(F.length("text"))).first()[0]
    assert sizes[-1] <= longest + 3 * 20_000


def test_few_rows(spark, no_docs):
    assert om.edit_neighbours(no_docs).collect() == []
    one = spark.createDataFrame([(5, "lonely text")], "doc_id long, text string")
    assert [tuple(r) for r in om.edit_neighbours(one).collect()] == slow_rows([(5, "lonely text")])


def test_signatures(edge_docs):
    got = sorted(map(tuple, om.signatures(edge_docs).collect()), key=str)
    assert got == sorted(((r.doc_id, om.to_hex(om.signature(om.code_points(r.text))))
                          for r in edge_docs.collect()), key=str)
