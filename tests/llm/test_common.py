from __future__ import annotations

import os

from tallyspark.llm import common


def test_pick_finds_exact_names(spark):
    d = spark.createDataFrame([(1, "a", "b", "c")], "doc_id long, Text string, text string, x string")
    assert common.pick(d, "doc_id", "text").collect() == [(1, "b")]
    twice = d.toDF("doc_id", "text", "text", "x")
    assert common.pick(twice, "text", "x").collect() == [("a", "c")]


def test_positional_restores_names(spark):
    d = spark.createDataFrame([(1, "a", "b")], "id long, text string, TEXT string")
    flat, name = common.positional(d)
    assert name == {"id": "_c0", "text": "_c1", "TEXT": "_c2"}
    assert flat.toDF(*d.columns).columns == d.columns


def test_stored_tables_can_be_released(spark, monkeypatch):
    monkeypatch.setattr(common, "_MADE", {})
    d = common.stored(spark.range(7), "seven")
    assert d.count() == 7
    [folder] = common._MADE[spark.sparkContext.applicationId]
    assert os.path.exists(folder.removeprefix("file:"))
    common.release(spark)
    assert not os.path.exists(folder.removeprefix("file:"))


def test_fold_is_the_same_in_python(spark):
    rows = [(i,) for i in (*range(50), -3, None)]
    d = spark.createDataFrame(rows, "doc_id long").select("doc_id", common.crc_fold("doc_id").alias("f"))
    assert all(r.f == common.crc_fold_py(r.doc_id) for r in d.collect())
