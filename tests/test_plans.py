"""Physical-plan properties the models rely on at scale."""

from __future__ import annotations

import contextlib
import io
import re
import tempfile

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tallyspark.functions.joins import matches, spread_null_key
from tallyspark.operators import monthly, revenue, staging
from tallyspark.plans import ModelSet
from tallyspark.session import AS_OF_TEST
from tallyspark.sources import derive_billing_tables, read_billing_tables


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored(spark):
    """The derived billing tables stored as Parquet, as real inputs would be."""
    d = tempfile.mkdtemp(prefix="plans-")
    for name, df in derive_billing_tables(spark, SF_SMALL).as_dict().items():
        df.write.parquet(f"{d}/{name}")
    return read_billing_tables(spark, d), d


def _scans(text: str, table: str) -> list[str]:
    """PushedFilters of every Parquet scan of ``table``."""
    out = []
    for block in text.split("\n\n"):
        if "Scan parquet" in block and re.search(rf"/{table}\]", block):
            m = re.search(r"PushedFilters: (.*)", block)
            out.append(m.group(1) if m else "")
    return out


def test_revenue_reads_invoices_once_in_full(spark, stored):
    t, _ = stored
    subs = staging.stg_subscription(t.subscription_history,
                                    staging.stg_customer(t.customer, t.card),
                                    staging.stg_subscription_item(
                                        t.subscription_item, t.price, t.product,
                                        t.product_config, t.tier))
    text = plan(revenue.revenue(t.invoice, subs, AS_OF_TEST))
    scans = _scans(text, "invoice")
    full = [s for s in scans if "GreaterThanOrEqual(period_end" not in s]
    assert len(full) == 1, scans
    assert len(scans) == 2      # and the last two months once, for the expected invoices
    # the as-of bound reaches the scan of every invoice read
    assert all("LessThan(period_end" in s for s in scans)


def test_monthly_models_need_no_join(spark):
    rev = monthly.customer_months(spark.createDataFrame(
        [], "stripe_customer_id string, recognized_at date, month date, amount double"))
    for df in [monthly.monthly_arr(rev, AS_OF_TEST), monthly.monthly_customers(rev, AS_OF_TEST)]:
        text = plan(df)
        assert "Join" not in text
        assert text.count("Window") >= 2  # per customer, then one row per month


def test_expected_invoices_read_two_months_once(spark, stored):
    t, _ = stored
    text = plan(revenue.expected_invoices(t.invoice, _subscriptions(t), AS_OF_TEST))
    assert len(_scans(text, "invoice")) == 1 and "LeftAnti" not in text


def test_prices_are_built_and_joined_once(spark, stored):
    """A stored table of priced lines: prices, products, tiers and lines are read once, and the
    model itself reads only that table. No row per line and tier arises."""
    t, _ = stored
    ms = ModelSet(t, AS_OF_TEST, materialize=["stg_subscription_item"])
    lines = staging.priced_items(t.subscription_item, ms.prices, t.tier)
    text = plan(lines)
    for table in ("subscription_item", "price", "tier", "product"):
        assert len(_scans(text, table)) == 1, table
    assert lines.count() == t.subscription_item.count()
    model = staging.items_with_amounts(ms.model("priced_items"))
    text = plan(model)
    assert not any(_scans(text, x) for x in ("subscription_item", "price", "tier", "product"))
    assert text.count("Scan parquet") >= 2 and model.count() == lines.count()
    ms.close()


def test_hot_item_id_is_split(spark):
    """A third of all lines share one id: the join with the sums per id is split."""
    n = 30_000
    lines = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("si"), "id")).alias("id"),
        F.lit(None).cast("timestamp").alias("created"), F.lit(1).cast("long").alias("quantity"),
        F.col("id").cast("string").alias("subscription_id"), F.lit("p").alias("plan_id"),
        *[F.lit("x").alias(c) for c in staging.LINE_COLUMNS[5:]],
        F.lit(2).cast("long").alias("line_cents"))
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
        df = staging.items_with_amounts(lines)
        rows = df.groupBy("price_amount").count().collect()
        df.collect()
        final = plan(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert {(r["price_amount"], r["count"]) for r in rows} == {(n / 3 * 2 / 100, n // 3),
                                                               (0.02, n - n // 3)}
    assert "skew=true" in final


def _subscriptions(t):
    return staging.stg_subscription(
        t.subscription_history, staging.stg_customer(t.customer, t.card),
        staging.stg_subscription_item(t.subscription_item, t.price, t.product, t.product_config,
                                      t.tier))


def test_building_plans_runs_no_job(spark, stored):
    t, _ = stored
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    ms = ModelSet(t, AS_OF_TEST)
    for name in ms.names:
        ms.model(name)
    staging.item_amount(t.subscription_item, t.price, t.product, t.product_config, t.tier)
    assert len(tracker.getJobIdsForGroup()) == before


def test_no_join_is_hinted(spark, stored):
    t, _ = stored
    for name in ModelSet.NAMES:
        logical = ModelSet(t, AS_OF_TEST).model(name)._jdf.queryExecution().analyzed().toString()
        assert "ResolvedHint" not in logical and "UnresolvedHint" not in logical


def test_hot_subscription_is_split(spark, stored):
    """Half of the invoices on one subscription: the join is followed by an exchange over
    all columns, so that it is a stage of its own, which adaptive execution splits, and the
    subscription's rows spread over the tasks of the distinct."""
    t, _ = stored
    subs = _subscriptions(t)
    hot = subs.where("plan_recurring_interval = 'month' and plan_recurring_interval_count = 1"
                     ).first()["id"]
    inv = t.invoice.withColumn("subscription_id", F.when(
        F.pmod(F.xxhash64("id"), F.lit(2)) == 0, F.lit(hot)).otherwise(F.col("subscription_id")))
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
        df = revenue.revenue(inv, subs, AS_OF_TEST)
        assert df.count() > 0
        df.collect()
        final = plan(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in final
    assert re.search(r"hashpartitioning\(recognized_at.*?amount.*?REPARTITION_BY_COL", final)


def test_revenue_moves_once_behind_the_join(spark, stored):
    """Without a hot subscription the instalments, both distincts and the consolidation lie as
    the join left them; with one, the join is split and the rows are dealt by all columns. The
    rows are the same."""
    t, _ = stored
    subs = _subscriptions(t)
    hot = subs.where("plan_recurring_interval = 'year' and plan_recurring_interval_count = 1"
                     ).first()["id"]
    inv = t.invoice.withColumn("subscription_id", F.when(
        F.pmod(F.xxhash64("id"), F.lit(2)) == 0, F.lit(hot)).otherwise(F.col("subscription_id")))
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    split = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    before = {k: spark.conf.get(k, None) for k in keys | split}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = revenue.revenue(inv, subs, AS_OF_TEST)
        rows = sorted(map(str, df.collect()))
        once = plan(df)
        for k, v in split.items():
            spark.conf.set(k, v)
        df = revenue.revenue(inv, subs, AS_OF_TEST)
        assert sorted(map(str, df.collect())) == rows
        spread = plan(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    dealt = re.compile(r"hashpartitioning\((?=.*recognized_at).*amount.*ENSURE_REQUIREMENTS")
    assert "skew=true" not in once and not dealt.search(once)
    assert not re.search(r"hashpartitioning\(_(month|groupingexpression)", once)
    assert "skew=true" in spread and dealt.search(spread)


def test_null_foreign_keys_spread_but_never_match(spark):
    rows = [(f"in_{i}", None if i % 3 else f"cus_{i % 50}") for i in range(3000)]
    inv = spark.createDataFrame(rows, "id string, customer_id string")
    cust = spark.createDataFrame([(f"cus_{i}", f"N{i}") for i in range(50)], "cid string, name string")
    key = spread_null_key(F.col("customer_id"), F.col("id"))
    spread = inv.where(F.col("customer_id").isNull()).select(key.alias("k"))
    assert spread.distinct().count() == 2000        # the rows no longer share any key
    # an id that reads like a spread key matches nothing
    fake = cust.unionByName(spread.limit(5).select(F.col("k").alias("cid"), F.lit("no").alias("name")))
    plain = inv.join(fake, inv.customer_id == fake.cid, "left").select("id", "name")
    joined = inv.join(fake, matches(inv.customer_id, fake.cid, inv.id), "left").select("id", "name")
    assert sorted(plain.collect()) == sorted(joined.collect())
