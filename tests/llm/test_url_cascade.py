from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import pytest

from tallyspark.llm import url_cascade as uc
from tallyspark.llm.queries import op3_url_cascade

SF = "/root/testdata/sf0.001"
ODD = [None, "", "no scheme", "://", "http://", "HTTP://A.Example.NET/en/x?q#f",
       "http://example.net/en/", "http://example.net/en", "http://x.example.com/de/1",
       "http://notexample.com/de/1", "ftp://a.org/fr/#z", "http://a.org?x=/fr/", "a://b://c/d",
       "http://casino-win.example.com/en/1", "http://CASINO.example.com", "http://É.net/ü",
       "http://mycasinox.example.com/", "http://spam-farm.example.org/fr/2"]


def slow(url, universe_listed=None):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for h, p, v in uc.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, v)
    listed = any(w in uc.LISTED_WORDS for w in re.split("[.-]", host))
    return (host, path, best and best[0], best[1] if best else "block" if listed else "allow")


def pages(spark, urls):
    rows = [(i, u, "<p>", "x") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, listed string")


def test_pages_and_odd_urls(spark):
    d = spark.read.parquet(f"{SF}/pages.parquet")
    for p in (d, pages(spark, ODD + ODD)):
        urls = {r.page_id: r.url for r in p.collect()}
        out = uc.judge_pages(p).collect()
        assert len(out) == len(urls)
        for r in out:
            assert (r.host, r["path"], r.rule, r.verdict) == slow(urls[r.page_id])
    assert uc.judge_pages(pages(spark, []).where("false")).collect() == []


def test_oracle(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    res = con.execute(uc.ORACLE_SQL)
    cols = [c[0] for c in res.description]
    want = sorted(res.fetchall(), key=str)
    got = op3_url_cascade(spark, SF).select(*cols).collect()
    assert sorted(map(tuple, got), key=str) == want


@pytest.mark.parametrize("n,share", [(0, 0), (1, 1), (5000, 0.1), (5000, 0.9), (3000, 0.0),
                                     (3000, 1.0)])
def test_cascade_is_exact(n, share):
    rng = np.random.default_rng(n)
    h = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    listed = rng.random(len(h)) < share
    c = uc.Cascade.unpacked(uc.Cascade.build(h, listed, 3, 2).packed())
    assert (c.listed(h) == listed).all()
    if 0 < share < 1:
        assert len(c.levels) > 2  # the levels did alternate


@pytest.mark.parametrize("how", [{}, {"broadcast_bytes": 0, "rows_per_task": 50}])
def test_shards_hot_keys_and_both_ways(spark, how):
    rng = random.Random(1)
    keys = [f"k{i}" for i in range(900)]
    rows = [(i, rng.choice(keys)) for i in range(1500)] + [(5000 + i, "hot") for i in range(700)]
    rows += [(9000, None), (9001, "")]
    listed = [(k,) for k in keys if rng.random() < 0.3] + [("hot",), ("unasked",), (None,)]
    d = spark.createDataFrame(rows, "id long, key string")
    li = spark.createDataFrame(listed, "key string")
    f = uc.CascadeFilter.build(d, li, shard_keys=100)
    assert f.shards > 5
    out = f.ask(d, "key", "bad", **how)
    assert out.columns == ["id", "key", "bad"] and out.count() == len(rows)
    on = {k for k, in listed if k is not None}
    for r in out.collect():
        assert r.bad == (r["key"] in on)
