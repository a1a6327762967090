from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyspark.llm import simhash_vptree as sv
from tallyspark.llm.components import _large_star, connected_components


def slow_fingerprint(text, k=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, cur = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += c
    if not words:
        return 0
    grams = ([" ".join(words[i:i + k]) for i in range(len(words) - k + 1)]
             if len(words) >= k else [" ".join(words)])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(points, r):
    """Brute force: the least member of every point's component."""
    root = {p: p for p in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pts = sorted(points)
    for i, a in enumerate(pts):
        for b in pts[i + 1:]:
            if bin(a ^ b).count("1") <= r:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in points}


def brute(rows, r=3):
    fps = [(i, slow_fingerprint(t)) for i, t in rows]
    comp = components({f for _, f in fps}, r)
    least = {}
    for i, f in fps:
        if i is not None:
            least[comp[f]] = min(i, least.get(comp[f], i))
    return sorted(((i, format(f, "016x"), least.get(comp[f])) for i, f in fps), key=str)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("tree", [{}, {"leaf_target": 20, "min_sample": 2}])
def test_documents_match_brute_force(docs, tree):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(sv.simhash_components(docs, **tree)) == brute(rows)


def test_edge_rows(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert got(sv.simhash_components(edge_docs)) == brute(rows)
    assert sv.simhash_components(no_docs).collect() == []


def cloud(seed, n=600):
    """Random points, and dense groups of near ones."""
    rng = random.Random(seed)
    pts = {rng.getrandbits(64) for _ in range(n)}
    for _ in range(6):
        c = rng.getrandbits(64)
        for _ in range(60):
            p = c
            for b in rng.sample(range(64), rng.randint(0, 4)):
                p ^= 1 << b
            pts.add(p)
    return sorted(pts)


@pytest.mark.parametrize("seed,opts", [
    (1, {"leaf_target": 10_000}),
    (2, {"leaf_target": 30, "min_sample": 2}),
    (3, {"leaf_target": 30, "min_sample": 2, "sample": 60, "max_shard": 40}),
    (4, {"leaf_target": 100, "min_sample": 4, "block": 37}),
    (5, {"leaf_target": 10_000, "block": 50}),
])
def test_tree_finds_every_link(spark, seed, opts):
    pts = cloud(seed)
    signed = [int(np.uint64(p).view(np.int64)) for p in pts]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    links = sv.near_links(df, 3, **opts)
    assert links.count() <= 40 * len(pts)
    roots = {r.node: r.root for r in connected_components(links).collect()}
    want = components(pts, 3)
    groups = {}
    for p, s in zip(pts, signed, strict=True):
        groups.setdefault(want[p], set()).add(s)
    mine = {}
    for s in signed:
        mine.setdefault(roots.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_keep_one_per_component(edge_docs, docs, no_docs):
    kept = sv.keep_one_per_component(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted([r.doc_id for r in kept.collect()], key=str)
    comp = {(r.doc_id, r.component_root) for r in sv.simhash_components(edge_docs).collect()}
    assert len(ids) == len({c for _, c in comp})
    assert ids.count(2) == 0 and ids.count(1) == 0 and -5 in ids and None in ids
    kept = sv.keep_one_per_component(docs)
    want = {c for *_, c in brute([(r.doc_id, r.text) for r in docs.collect()])}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert sv.keep_one_per_component(no_docs).collect() == []


def test_repeated_row_stays_once(spark):
    d = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "q r s t u v")],
                              "doc_id long, text string")
    assert sorted(r.doc_id for r in sv.keep_one_per_component(d).collect()) == [1, 2]


def test_a_hub_is_split(spark):
    """Nearly all edges meet in one vertex: the join with its minimum reads shuffles of its own,
    which adaptive execution can split."""
    edges = spark.range(40_000).select((F.col("id") + 10).alias("a"), F.when(
        F.col("id") % 10 == 0, F.col("id") + 5).otherwise(F.lit(1)).cast("long").alias("b"))
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        star = _large_star(edges)
        star.collect()
        text = star._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in text
    assert {r["b"] for r in star.select("b").distinct().collect()} <= set(range(1, 40_011))


def test_many_large_shards_are_each_split(spark):
    """Eight clouds that lie apart: each is larger than a shard may be, and is split by a sample
    of its own; shards that do not split are left to the blocks."""
    rng = random.Random(3)
    points = set()
    for c in range(8):
        centre = rng.getrandbits(64)
        for _ in range(400):
            p = centre
            for b in rng.sample(range(64), 8):
                p ^= 1 << b
            points.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    links = sv.near_links(df, 3, leaf_target=200, min_sample=4, sample=100, max_shard=150)
    roots = {r.node: r.root for r in connected_components(links).collect()}
    want, mine = {}, {}
    component = components(points, 3)
    for p, s in zip(points, signed, strict=True):
        want.setdefault(component[p], set()).add(s)
        mine.setdefault(roots.get(s, s), set()).add(s)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, mine.values()))


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(300)]
    edges += [(5, 5), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    roots = {r.node: r.root for r in connected_components(df).collect()}
    assert {roots[i] for i in range(301)} == {0}
    assert {roots[2000 + i] for i in range(300)} == {1000}
