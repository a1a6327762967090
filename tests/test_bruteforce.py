"""Spark rules vs plain-Python brute force on many random small cases."""

from __future__ import annotations

import calendar
import datetime as dt
import random

from conftest import billing
from pyspark.sql import functions as F

from tallyspark.functions.dates import stepped_month_starts
from tallyspark.operators import staging


def _tiered_amount(q, tiers):
    """Graduated pricing by hand: tiers as (up_to, flat, unit) in index order."""
    total, prev = None, None
    for up_to, flat, unit in tiers:
        part = None
        if q is not None and up_to is not None and q > up_to:
            part = flat if flat is not None else (
                (up_to - (prev or 0)) * unit if unit is not None else None)
        elif q is None:
            part = flat if (prev is None and up_to is None) else None
        elif (prev is None or q > prev) and (up_to is None or q <= up_to):
            part = flat if flat is not None else (
                (q - (prev or 0)) * unit if unit is not None else None)
        if part is not None:
            total = (total or 0) + part
        prev = up_to
    return total


def test_tier_pricing_matches_brute_force(spark):
    r = random.Random(3)
    prices, tiers, items, expected = [], [], [], {}
    for i in range(60):
        pid = f"p{i}"
        prices.append({"id": pid, "billing_scheme": "tiered", "unit_amount": 100,
                       "livemode": True, "is_deleted": False})
        bound, spec = 0, []
        for k in range(r.randrange(1, 5)):
            bound += r.randrange(1, 12)
            up_to = None if (k == 3 or r.random() < 0.25) else bound
            flat = r.choice([None, None, 0, 700])
            unit = r.choice([None, 5, 120, 999])
            tiers.append({"id": pid, "index": k, "up_to": up_to, "flat_amount": flat,
                          "unit_amount": unit})
            spec.append((up_to, flat, unit))
            if up_to is None:
                break
        bounds = [u for u, _, _ in spec if u is not None]
        for j, q in enumerate({None, 0, 1, *bounds, *[b + 1 for b in bounds],
                               r.randrange(0, 60)}):
            iid = f"{pid}_{j}"
            items.append({"id": iid, "quantity": q, "plan_id": pid})
            expected[iid] = _tiered_amount(q, spec)
    t = billing(spark, price=prices, tier=tiers, subscription_item=items)
    out = staging.stg_subscription_item(t.subscription_item, t.price, t.product,
                                        t.product_config, t.tier)
    got = {row.id: (None if row.c is None else row.c)
           for row in out.select("id", F.round(F.col("price_amount") * 100)
                                 .cast("bigint").alias("c")).collect()}
    assert len(got) == len(expected) > 300
    assert got == expected


def _pg_series_months(start: dt.date, stop: dt.date) -> list[dt.date]:
    """Month starts visited by start, start+1 month, (start+1 month)+1 month, ...
    while not past stop, each step clamped to the month's length."""
    out, v = [], start
    while v <= stop:
        out.append(v.replace(day=1))
        y, m = (v.year, v.month + 1) if v.month < 12 else (v.year + 1, 1)
        v = dt.date(y, m, min(v.day, calendar.monthrange(y, m)[1]))
    return out


def test_stepped_calendar_matches_brute_force(spark):
    r = random.Random(5)
    cases = []
    for _ in range(400):
        start = dt.date(1999, 1, 1) + dt.timedelta(days=r.randrange(0, 900))
        if r.random() < 0.3:  # month ends, the interesting case
            start = start.replace(day=calendar.monthrange(start.year, start.month)[1])
        stop = start + dt.timedelta(days=r.randrange(-40, 500))
        if r.random() < 0.3:  # stop near a month end or start
            last = calendar.monthrange(stop.year, stop.month)[1]
            stop = stop.replace(day=min(r.choice([28, 29, 30, 31, 1]), last))
        cases.append((start, stop))
    df = spark.createDataFrame(cases, "start date, stop date")
    rows = df.select("start", "stop", stepped_month_starts("start", "stop").alias("m")).collect()
    for row in rows:
        assert list(row.m) == _pg_series_months(row.start, row.stop), (row.start, row.stop)
