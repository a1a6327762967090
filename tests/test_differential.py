"""Randomised differential test: Spark models vs the DuckDB oracle on the same
hand-generated billing tables, full of NULLs, ties, month ends, refunds, odd
statuses, duplicate invoices and future dates."""

from __future__ import annotations

import collections
import datetime as dt
import os
import random
import uuid

import duckdb
import pyarrow as pa
import pytest
from conftest import billing

import __spark_entry__ as se
from oracle.models_sql import KEYS, compose
from tallyspark.plans import SHARED_MODELS, ModelSet
from tallyspark.sources.schemas import BILLING_SCHEMAS

AS_OF = dt.date(2001, 6, 15)
SKIP = {k for k in KEYS if k.startswith("src_")}


def _day(r: random.Random) -> dt.datetime:
    base = dt.date(1999, 1, 1) + dt.timedelta(days=r.randrange(0, 1000))
    if r.random() < 0.15:  # month ends
        nxt = (base.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        base = nxt - dt.timedelta(days=1)
    return dt.datetime(base.year, base.month, base.day, r.choice([0, 0, 0, 13]))


def _maybe(r, v, p=0.15):
    return None if r.random() < p else v


def make_tables(seed: int, hot: bool = False) -> dict[str, list[dict]]:
    """Random billing tables; with ``hot``, a third of all invoices belong to one
    subscription of one customer (a hot key for every revenue shuffle), and a few
    subscriptions have two active versions."""
    r = random.Random(seed)
    n_cust, n_price, n_sub = 60, 40, 150
    cust = [{"id": f"cus_{i}", "name": _maybe(r, f"N{i}", 0.3),
             "description": _maybe(r, f"d{i}", 0.5), "email": f"U{i}@X.COM",
             "created": _day(r), "address_country": _maybe(r, "US", 0.5),
             "shipping_address_country": _maybe(r, "CA", 0.5),
             "default_card_id": _maybe(r, f"card_{i}", 0.3), "balance": r.randrange(-500, 500),
             "livemode": r.random() > 0.1, "is_deleted": r.random() < 0.05}
            for i in range(n_cust)]
    card = [{"id": f"card_{i}", "country": "DE"} for i in range(0, n_cust, 2)]
    product = [{"id": f"prod_{i}", "name": f"P{i}"} for i in range(4)]
    config = [{"product_id": "prod_0", "name": "Main", "is_main_product": True},
              {"product_id": "prod_1", "name": "Addon", "is_main_product": False},
              {"product_id": "prod_2", "name": None, "is_main_product": None}]
    price, tier = [], []
    for i in range(n_price):
        scheme = r.choice(["per_unit", "per_unit", "tiered", "tiered", None, "other"])
        price.append({
            "id": f"price_{i}", "created": _day(r), "active": True, "nickname": f"nick{i}",
            "type": "recurring", "billing_scheme": scheme,
            "recurring_interval": r.choice(["month", "month", "month", "year", "year",
                                            "week", None]),
            "recurring_interval_count": r.choice([1, 1, 1, 1, 1, 2, 3, 5, 6, None]),
            "tiers_mode": r.choice(["graduated", "volume", None]),
            "unit_amount": _maybe(r, r.randrange(0, 50000), 0.1),
            "product_id": r.choice(["prod_0", "prod_0", "prod_0", "prod_1", "prod_2",
                                    "prod_3", "prod_x", None]),
            "livemode": r.random() > 0.05, "is_deleted": r.random() < 0.05})
        if scheme == "tiered" or r.random() < 0.1:
            bound = 0
            for k in range(r.randrange(1, 4)):
                bound += r.randrange(1, 15)
                last = k == 2 or r.random() < 0.3
                tier.append({"id": f"price_{i}", "index": k, "up_to": None if last else bound,
                             "flat_amount": r.choice([None, None, 0, 5000]),
                             "unit_amount": _maybe(r, r.randrange(0, 3000), 0.1)})
                if last:
                    break
    subs, items = [], []
    for i in range(n_sub):
        created = _day(r)
        cancel = _maybe(r, created + dt.timedelta(days=r.randrange(-30, 700)), 0.75)
        trial = r.random() < 0.5
        subs.append({
            "id": f"sub_{i}", "created": created, "billing_cycle_anchor": created,
            "cancel_at": cancel, "canceled_at": _maybe(r, _day(r), 0.85),
            "current_period_start": created,
            "current_period_end": _maybe(r, _day(r) + dt.timedelta(days=400), 0.3),
            "trial_start": created if trial else None,
            "trial_end": created + dt.timedelta(days=14) if trial else None,
            "cancel_at_period_end": r.choice([True, False, False, None]),
            "status": r.choice(["active", "active", "canceled", "trialing", None]),
            "collection_method": "charge_automatically",
            "customer_id": r.choice([f"cus_{r.randrange(n_cust + 3)}", None]),
            "livemode": r.random() > 0.05, "_fivetran_active": True})
        if r.random() < 0.1:  # an old inactive version of the same subscription
            subs.append({**subs[-1], "_fivetran_active": False, "status": "old"})
        for k in range(r.randrange(0, 4)):
            items.append({"id": f"si_{i}_{k}", "created": r.choice([created, _day(r)]),
                          "quantity": _maybe(r, r.randrange(0, 40), 0.05),
                          "subscription_id": _maybe(r, f"sub_{i}", 0.05),
                          "plan_id": f"price_{r.randrange(n_price + 2)}"})
    invoices = []

    def invoice(i, s, pe):
        total = r.choice([r.randrange(100, 100000), r.randrange(100, 100000), 0, -500])
        row = {"id": f"in_{i}", "number": f"N{i}", "created": pe, "period_start": pe,
               "period_end": pe, "paid": True, "auto_advance": True, "attempted": True,
               "status": r.choice(["paid", "paid", "paid", "open", "void", "uncollectible",
                                   "deleted", None]),
               "collection_method": "charge_automatically", "total": total,
               "amount_due": total, "amount_paid": total, "amount_remaining": 0,
               "attempt_count": 1, "customer_id": r.choice([f"cus_{s % n_cust}",
                                                            f"cus_{s % n_cust}", None]),
               "subscription_id": f"sub_{s}", "charge_id": f"ch_{i}",
               "livemode": r.random() > 0.03, "is_deleted": r.random() < 0.03}
        invoices.append(row)
        if r.random() < 0.05:  # an identical twin
            invoices.append({**row, "id": f"in_{i}_twin"})

    n = 0
    for s in range(n_sub + 2):
        # a run of monthly invoices with gaps, many ending around the as-of month
        start = r.randrange(0, 30) if r.random() < 0.5 else r.randrange(24, 29)
        day = r.choice([1, 15, 28, 29, 30, 31])
        for m in range(start, min(start + r.randrange(1, 18), 31)):
            if r.random() < 0.15:
                continue
            y, mo = divmod(1999 * 12 + m, 12)
            last = (dt.date(y + (mo + 1) // 12, (mo + 1) % 12 + 1, 1) - dt.timedelta(days=1)).day
            invoice(n, s, dt.datetime(y, mo + 1, min(day, last)))
            n += 1
    for _ in range(100):
        invoice(n, r.randrange(n_sub + 2), _day(r) + dt.timedelta(days=r.randrange(0, 500)))
        n += 1
    if hot:
        # two live, active versions of a few subscriptions (they fan out in joins)
        for sub in [x for x in subs if x["_fivetran_active"]][1:6]:
            subs.append({**sub, "customer_id": f"cus_{r.randrange(n_cust)}",
                         "cancel_at_period_end": not sub["cancel_at_period_end"]})
        subs[0].update({"customer_id": "cus_0", "livemode": True, "_fivetran_active": True})
        items.append({"id": "si_hot", "created": dt.datetime(1990, 1, 1), "quantity": 1,
                      "subscription_id": "sub_0", "plan_id": "price_hot"})
        price.append({"id": "price_hot", "billing_scheme": "per_unit", "unit_amount": 999,
                      "recurring_interval": "month", "recurring_interval_count": 1,
                      "product_id": "prod_0", "livemode": True, "is_deleted": False})
        for _ in range(len(invoices) // 2):
            invoice(n, 0, _day(r) + dt.timedelta(days=r.randrange(0, 500)))
            n += 1
    return {"customer": cust, "card": card, "product": product, "product_config": config,
            "price": price, "tier": tier, "subscription_item": items,
            "subscription_history": subs, "invoice": invoices}


def _arrow(name: str, rows: list[dict]) -> pa.Table:
    types = {"StringType()": pa.string(), "TimestampType()": pa.timestamp("us"),
             "BooleanType()": pa.bool_(), "LongType()": pa.int64()}
    fields = BILLING_SCHEMAS[name].fields
    schema = pa.schema([(f.name, types[str(f.dataType)]) for f in fields])
    return pa.Table.from_pylist([{f.name: r.get(f.name) for f in fields} for r in rows],
                                schema=schema)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(
        tuple((r[i] + 0.0) if isinstance(r[i], float) else r[i] for i in order) for r in rows)


@pytest.mark.parametrize("seed,hot", [(7, False), (11, False), (23, False), (5, True)])
def test_random_tables_match_oracle(spark, seed, hot):
    rows = make_tables(seed, hot)
    # an item id that occurs twice, and an item without one, on per-unit prices
    flat = {p["id"] for p in rows["price"] if p.get("billing_scheme") == "per_unit"}
    odd = [i for i in rows["subscription_item"] if i.get("plan_id") in flat
           and i.get("created") is not None][:2]
    rows["subscription_item"] += [dict(odd[0])] + [
        dict(i, id=None, created=i["created"] + dt.timedelta(days=1)) for i in odd[1:]]
    tables = billing(spark, **rows)
    fake_dir = f"/nonexistent/random-{seed}-{uuid.uuid4().hex}"
    se._MODEL_SETS[(spark.sparkContext.applicationId, fake_dir)] = (None, ModelSet(
        tables, AS_OF, materialize=SHARED_MODELS))
    con = duckdb.connect()
    for name, rs in rows.items():
        con.register(f"src_{name}", _arrow(name, rs))
    given = frozenset(f"src_{n}" for n in rows)
    queries = se.queries()
    failures = []
    for key, final in KEYS.items():
        if key in SKIP:
            continue
        df = queries[key](spark, fake_dir)
        s_rows = [tuple(x) for x in df.collect()]
        res = con.execute(compose(final, given))
        o_cols = [d[0] for d in res.description]
        o_rows = res.fetchall()
        if sorted(df.columns) != sorted(o_cols) or _bag(df.columns, s_rows) != _bag(o_cols,
                                                                                     o_rows):
            a, b = _bag(df.columns, s_rows), _bag(o_cols, o_rows)
            failures.append((key, len(s_rows), len(o_rows), list((a - b).elements())[:2],
                             list((b - a).elements())[:2]))
    assert not failures, failures
