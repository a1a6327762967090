from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyspark.llm import decision_list as dl

WORD = re.compile("[^\x20\x09-\x0D]+")


def slow_counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def check_base(out, d):
    mine = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                    r.n_repeat_words, r.base_failed) for r in out.collect()), key=str)
    assert mine == sorted(((r.doc_id, *slow_counts(r.text)) for r in d.collect()), key=str)


def test_counts_match_brute_force(docs, edge_docs, labels):
    for d in (docs, edge_docs):
        out = dl.judge(d, labels)
        check_base(out, d)
        assert out.where("base_failed and kept").count() == 0


def test_empty_tables_and_odd_labels(spark, no_docs, edge_docs, labels):
    assert dl.judge(no_docs, labels).collect() == []
    assert dl.keep_good(no_docs, labels).collect() == []
    none = labels.where("false")
    for r in dl.judge(edge_docs, none).collect():
        assert r.kept == (not r.base_failed) and r["rule"] is None
    odd = spark.createDataFrame([(1, None), (None, 0), (1, 1), (1, 0), (99, 0)],
                                "doc_id long, quality int")
    assert dl.judge(edge_docs, odd).count() == edge_docs.count()


def test_learned_rules_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(2)) == 0
    out = dl.judge(docs, labels.where(fold)).join(labels.where(~fold), "doc_id").collect()
    good = [r for r in out if r.quality == 1 and not r.base_failed]
    bad = [r for r in out if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)


def test_keep_good_equals_judge(docs, labels, edge_docs):
    for d in (docs, edge_docs):
        kept = dl.keep_good(d, labels)
        assert kept.columns == d.columns
        want = sorted((r.doc_id for r in dl.judge(d, labels).where("kept").collect()), key=str)
        assert sorted((r.doc_id for r in kept.collect()), key=str) == want


def test_list_on_planted_rules(spark):
    rows = []
    for i in range(3000):
        sym, up = (i * 37 % 100), (i * 61 % 100)
        bad = sym > 60 or (up > 80 and sym < 20)
        rows.append((i, 100, 500, sym, 0, 0, 10, up * 5, 0, 10, bad))
    d = spark.createDataFrame(rows, "doc_id long, n_words long, word_chars long, n_symbols long, "
                              "n_dup_lines long, n_repeat_words long, n_lines long, "
                              "n_upper long, n_shouts long, n_stops long, bad boolean")
    learned = dl.learn_decision_list(d)
    assert learned.rules and all(len(r.conditions) <= dl.MAX_CONDITIONS for r in learned.rules)
    wrong = d.where(learned.keeps() == F.col("bad")).count()
    assert wrong <= 0.06 * len(rows)
    ordered = d.select(learned.rule_number().alias("k"), learned.keeps().alias("kept"))
    assert ordered.where("kept = (k is not null)").count() == 0


def test_plan_is_native(docs, labels):
    plan = dl.judge(docs, labels)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("text,n", [("a b c a b c", 6), ("a a a a", 4), ("a b c d", 0),
                                    ("a b c x a b c y b c x", 10), ("", 0)])
def test_repeat_words(spark, text, n):
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert dl.text_statistics(d).first().n_repeat_words == n == slow_counts(text)[4]
