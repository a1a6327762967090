"""Sinks and the model graph: tables, cache, CSV export, build_until, ad-hoc SQL."""

from __future__ import annotations

import dataclasses
import datetime as dt
import os
import tempfile
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tallyspark.plans import ModelSet, sinks
from tallyspark.plans.names import named_tables
from tallyspark.plans.versions import VersionLog
from tallyspark.session import AS_OF_TEST
from tallyspark.sources import derive_billing_tables


def _folder(name):
    return os.path.join(tempfile.mkdtemp(prefix="sink-"), name)


def _versions(path):
    return [f for f in os.listdir(path) if f.startswith("v-")]


def test_model_table_create_keep_and_force(spark):
    path = _folder("t")
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2,)], "x int")
    assert [r.x for r in sinks.write_model_table(a, path).collect()] == [1]
    # a table of the same schema and stamp is kept without force
    assert [r.x for r in sinks.write_model_table(b, path).collect()] == [1]
    first = sinks.read_model_table(spark, path)
    assert [r.x for r in sinks.write_model_table(b, path, force=True).collect()] == [2]
    assert [r.x for r in sinks.read_model_table(spark, path).collect()] == [2]
    assert [r.x for r in first.collect()] == [1]    # a reader of the version before is not cut off
    # nor after any number of rebuilds within the retention time
    for i in range(3):
        sinks.write_model_table(spark.createDataFrame([(i,)], "x int"), path, force=True)
    assert [r.x for r in first.collect()] == [1]
    assert len(_versions(path)) == 5
    # versions that were replaced longer ago go, with their entries in the log
    last = sinks.write_model_table(b, path, force=True, retain=0)
    assert [r.x for r in last.collect()] == [2]
    assert len(_versions(path)) == len(sinks._finished(spark, path)) == 1
    assert sinks._finished(spark, path)[-1]["number"] == 6


def test_vacuum_removes_what_never_finished(spark):
    path = _folder("t")
    for i in range(2):
        sinks.write_model_table(spark.createDataFrame([(i,)], "x int"), path, force=True)
    spark.createDataFrame([(0,)], "x int").write.parquet(f"{path}/v-dead")
    sinks.vacuum(spark, path)
    assert len(_versions(path)) == 3                # all younger than the retention time
    sinks.vacuum(spark, path, retain=0)
    assert len(_versions(path)) == 1
    assert [r.x for r in sinks.read_model_table(spark, path).collect()] == [1]


def test_writers_at_once_all_enter_the_log(spark):
    path, n = _folder("t"), 6
    start = threading.Barrier(n)

    def write(i):
        df = spark.createDataFrame([(i,)], "x int")
        start.wait()
        return [r.x for r in sinks.write_model_table(df, path, force=True).collect()]

    with ThreadPoolExecutor(n) as pool:
        assert sorted(pool.map(write, range(n))) == [[i] for i in range(n)]
    done = sinks._finished(spark, path)
    assert [e["number"] for e in done] == list(range(1, n + 1))
    assert len({e["folder"] for e in done}) == n
    assert not [f for f in os.listdir(f"{path}/_versions") if "draft" in f and "crc" not in f]


def test_a_number_is_given_once(spark):
    """Writers that have listed the same versions race for one name."""
    log = VersionLog(spark, _folder("t"))
    assert log.latest() is None and log.enter({"folder": "a"}) == 1
    seen = [log.numbers()]
    log.numbers = lambda real=log.numbers: seen.pop() if seen else real()
    log.enter({"folder": "b"})
    seen[:] = [[(1, 0)]]                            # an old listing: 2 is taken meanwhile
    assert log.enter({"folder": "c"}) == 3
    assert [log.read(i)["folder"] for i in (1, 2, 3)] == ["a", "b", "c"]


def test_storing_a_model_is_one_spark_job(spark):
    path = _folder("t")
    df = spark.range(100).selectExpr("id as x")
    for force in (True, True, False):
        group = f"jobs-{uuid.uuid4().hex}"
        spark.sparkContext.setJobGroup(group, "model")
        try:
            sinks.write_model_table(df, path, force=force)
        finally:
            spark.sparkContext.setJobGroup("none", "none")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        assert len(jobs) == (1 if force else 0)


def test_other_stamp_or_schema_is_rebuilt(spark):
    path = _folder("t")
    sinks.write_model_table(spark.createDataFrame([(1,)], "x int"), path, stamp="as-of 2000")
    new = sinks.write_model_table(spark.createDataFrame([(2,)], "x int"), path, stamp="as-of 2001")
    assert [r.x for r in new.collect()] == [2]
    new = sinks.write_model_table(spark.createDataFrame([(3,)], "y int"), path, stamp="as-of 2001")
    assert [r.y for r in new.collect()] == [3]


def test_empty_foreign_or_unfinished_folder_is_rebuilt(spark):
    want = spark.createDataFrame([(7,)], "x int")
    empty = _folder("t")
    os.makedirs(empty)
    assert [r.x for r in sinks.write_model_table(want, empty).collect()] == [7]
    foreign = _folder("t")
    spark.createDataFrame([("a", 1.5)] * 3, "p string, q double").write.parquet(foreign)
    assert [r.x for r in sinks.write_model_table(want, foreign).collect()] == [7]
    # a version that was written but never entered in the log
    half = _folder("t")
    spark.createDataFrame([(0,)], "x int").write.parquet(f"{half}/v-dead")
    assert [r.x for r in sinks.write_model_table(want, half).collect()] == [7]
    try:
        sinks.read_model_table(spark, _folder("nothing"))
    except FileNotFoundError:
        pass
    else:
        raise AssertionError("a missing table was read")


def test_kept_models_follow_date_and_config(spark):
    tables, folder = derive_billing_tables(spark, SF_SMALL), _folder("models")

    def last_month(as_of, config=None, **kw):
        t = tables if config is None else dataclasses.replace(tables, product_config=config)
        ms = ModelSet(t, as_of, materialize=["revenue", "monthly_arr"], folder=folder,
                      force=False, **kw)
        return ms, ms.model("monthly_arr").agg(F.max("month")).first()[0]

    _, early = last_month(dt.date(2000, 3, 15))
    assert early == dt.date(2000, 3, 1)
    ms, late = last_month(AS_OF_TEST)
    assert late == AS_OF_TEST.replace(day=1)
    again, _ = last_month(AS_OF_TEST)
    assert sinks._finished(spark, again.table_path("revenue"))[-1]["number"] == 2  # kept
    other = tables.product_config.withColumn("is_main_product", F.lit(False))
    none, _ = last_month(AS_OF_TEST, other)
    assert sinks._finished(spark, none.table_path("revenue"))[-1]["number"] == 3
    assert none.model("revenue").count() < ms.model("revenue").count()  # fewer main products


def test_only_updated_models_are_persisted(spark):
    tables, folder = derive_billing_tables(spark, SF_SMALL), _folder("models")

    def build(**kw):
        ms = ModelSet(tables, AS_OF_TEST, materialize=["stg_customer"], folder=folder, **kw)
        return ms, ms.model("stg_customer")

    ms, df = build(cache=True)
    assert not ms.persisted and not df.is_cached      # new: stored, not persisted
    ms, df = build(cache=True)
    assert ms.persisted == {"stg_customer"} and df.is_cached
    ms.close()
    assert not df.is_cached
    ms, df = build(cache=False)
    assert not ms.persisted and not df.is_cached


def test_no_cache_frees_every_older_version(spark):
    """One registry for all model sets: what any of them has persisted for a path."""
    tables, folder = derive_billing_tables(spark, SF_SMALL), _folder("models")

    def held():
        return spark.sparkContext._jsc.getPersistentRDDs().size()

    def build(**kw):
        ms = ModelSet(tables, AS_OF_TEST, materialize=["stg_customer"], folder=folder, **kw)
        return ms, ms.model("stg_customer")

    before = held()
    build(cache=True)
    _, second = build(cache=True)
    second.count()
    assert held() == before + 1
    _, third = build(cache=True)                    # the newer one frees the older
    third.count()
    assert held() == before + 1 and not second.is_cached
    build(cache=False)
    assert held() == before and not third.is_cached
    # closing an old set leaves a newer set's version in memory
    old, _ = build(cache=True)
    _, newer = build(cache=True)
    newer.count()
    old.close()
    assert held() == before + 1 and newer.is_cached
    sinks.cache_model(newer, no_cache=True, path=f"{folder}/stg_customer/")
    assert held() == before


def test_cache_and_uncache(spark):
    df = spark.range(10)
    assert sinks.cache_model(df).is_cached
    assert not sinks.cache_model(df, no_cache=True).is_cached


def test_csv_export_keeps_labels_verbatim(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="csv-"), "e")
    df = spark.createDataFrame(
        [(dt.date(2001, 1, 1), "Q1 2001", "Trialer % Quarterly growth ", None),
         (dt.date(2001, 1, 1), "Q1 2001", "New ARR", 1.5)],
        "quarter date, quarter_name string, metric string, value double")
    back = sorted(sinks.export_csv(df, path, single_file=True).collect(), key=lambda r: r.metric)
    assert [r.metric for r in back] == ["New ARR", "Trialer % Quarterly growth "]
    assert back[1].value is None and back[0].value == 1.5
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1


def test_a_failing_export_leaves_the_published_one(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="csv-"), "e")

    def published():
        return sorted(r.x for r in spark.read.schema("x long").option("header", True)
                      .csv(path).collect())

    sinks.export_csv(spark.range(5).selectExpr("id as x"), path)
    bad = spark.range(5).select(F.when(F.col("id") > 3, F.raise_error(F.lit("broken")))
                                .otherwise(F.col("id")).cast("long").alias("x"))
    with pytest.raises(Exception, match="broken"):
        sinks.export_csv(bad, path)
    assert published() == [0, 1, 2, 3, 4]
    assert os.listdir(os.path.dirname(path)) == ["e"]       # nothing is left beside it
    assert sinks.export_csv(spark.range(2).selectExpr("id as x"), path).count() == 2
    assert published() == [0, 1] and os.listdir(os.path.dirname(path)) == ["e"]


def test_exports_at_once_leave_one_whole(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="csv-"), "e")
    frames = [spark.range(100 * i, 100 * i + 100).selectExpr("id as x") for i in range(4)]

    def export(df):
        stage = f"{path}.new-{uuid.uuid4().hex}"
        df.write.option("header", True).csv(stage)
        sinks._publish(spark, stage, path)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(export, frames))
    rows = sorted(r.x for r in spark.read.schema("x long").option("header", True).csv(path)
                  .collect())
    assert rows in [list(range(100 * i, 100 * i + 100)) for i in range(4)]
    assert os.listdir(os.path.dirname(path)) == ["e"]


def test_build_until_and_adhoc_sql(spark):
    ms = ModelSet(derive_billing_tables(spark, SF_SMALL), AS_OF_TEST,
                  materialize=["revenue"])
    arr = ms.build_until("monthly_arr")
    assert set(ms._built) == {"stg_customer", "priced_items", "stg_subscription_item",
                              "stg_subscription", "revenue", "customer_months", "monthly_arr"}
    n = ms.adhoc_sql("select count(*) as n from monthly_arr").collect()[0].n
    assert n == arr.count() > 0
    # the materialised model is a plain Parquet table in the checkpoint folder
    stored = sinks.read_model_table(spark, ms.table_path("revenue"))
    assert stored.count() == ms.model("revenue").count()
    folder = os.path.dirname(ms.table_path("revenue"))
    ms.close()
    assert not os.path.exists(folder)


def test_adhoc_sql_in_any_case_and_without_clobbering(spark):
    ms = ModelSet(derive_billing_tables(spark, SF_SMALL), AS_OF_TEST)
    spark.createDataFrame([(42,)], "mine int").createOrReplaceTempView("monthly_customers")
    try:
        df = ms.adhoc_sql("select *, 'stg_tier' as s -- quarterly_arr\nfrom Monthly_Customers")
        assert df.count() == ms.model("monthly_customers").count()
        assert "stg_tier" not in ms._built and "quarterly_arr" not in ms._built
        assert spark.table("monthly_customers").columns == ["mine"]
        assert ms.adhoc_sql("select count(*) c from RAW_tier").first().c == ms.tables.tier.count()
        assert not spark.catalog.tableExists("raw_tier")
    finally:
        spark.catalog.dropTempView("monthly_customers")


def test_names_that_a_text_looks_up(spark):
    def names(text):
        found, computed = named_tables(spark, text)
        assert not computed
        return {".".join(n) for n in found}

    assert names("select 1") == set()
    assert names("select a/100 /* from x */ from t where b/100 > (select max(c) from `U v`)"
                 " -- w") == {"t", "U v"}
    assert names("with a as (select * from r), b as (select * from a) select * from b join p "
                 "on true") == {"r", "p"}
    # a definition does not see itself, unless it is recursive
    assert names("with r as (select * from r) select * from r") == {"r"}
    assert names("with recursive r(n) as (select 1 union all select n + 1 from r where n < 5) "
                 "select * from r, m") == {"m"}
    # inner definitions count inside only
    assert names("select * from (with q as (select 1) select * from q) join q on true") == {"q"}
    assert names("select * from x where exists (select 1 from y where k in (select k from z)) "
                 "order by (select 1 from w)") == {"x", "y", "z", "w"}
    assert names("select * from a.b.c union all table d") == {"a.b.c", "d"}
    assert names("describe table e") == {"e"} == names("cache table c as select * from e")
    assert names("from f |> where x > 1 |> join g using (x)") == {"f", "g"}
    assert names("select \"h\" as s, 'from i' as t from `j` as k") == {"j"}
    assert named_tables(spark, "select * from identifier('m' || 'n')")[1]
    with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
        named_tables(spark, "selct 1")


ADHOC = """
    /* revenue and stg_tier are named in a comment */
    with big as (select price_id, unit_amount/100 as a from STG_TIER where unit_amount/100 > 0),
         `stg_price` as (select 1 as one)          -- hides the model
    select 'from monthly_arr' as label, "revenue" as other, count(*) as n,
           (select count(*) from raw_tier) as raw
    from big, `stg_price`
"""


def test_adhoc_sql_of_any_form(spark):
    ms = ModelSet(derive_billing_tables(spark, SF_SMALL), AS_OF_TEST)
    row = ms.adhoc_sql(ADHOC).first()
    assert row.n == ms.model("stg_tier").where("unit_amount/100 > 0").count() > 0
    assert row.label == "from monthly_arr" and row.other == "revenue"
    assert row.raw == ms.tables.tier.count()
    assert set(ms._built) == {"stg_tier"}
    assert not spark.catalog.tableExists("stg_tier")
    assert ms.adhoc_sql("select * from identifier('stg_' || 'tier')").count() == \
        ms.model("stg_tier").count()
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        ms.adhoc_sql("select * from no_such_model")


def test_adhoc_texts_at_once_do_not_mix_views(spark):
    """Two sets over other data, asked at the same time, each answer from their own."""
    tables = derive_billing_tables(spark, SF_SMALL)
    fewer = dataclasses.replace(tables, tier=tables.tier.limit(3))
    sets = [ModelSet(tables, AS_OF_TEST), ModelSet(fewer, AS_OF_TEST)] * 4
    with ThreadPoolExecutor(8) as pool:
        n = list(pool.map(lambda ms: ms.adhoc_sql("select count(*) c from stg_tier").first().c,
                          sets))
    assert n == [tables.tier.count(), 3] * 4
