"""Staging rules on hand-sized tables: tiers, plan choice, annual value, config."""

from __future__ import annotations

import pytest
from conftest import billing, ts

from tallyspark.operators import staging

LIVE = {"livemode": True, "is_deleted": False}


def _price(pid, scheme="tiered", interval="month", count=1, unit=1000, product="prod_a"):
    return {"id": pid, "billing_scheme": scheme, "recurring_interval": interval,
            "recurring_interval_count": count, "unit_amount": unit, "product_id": product,
            "created": ts(2000, 1, 1), **LIVE}


TIERS = [  # graduated: up to 10 at 5.00, 11..25 flat 0 (present!), above 25 at 1.00
    {"id": "p1", "index": 0, "up_to": 10, "flat_amount": None, "unit_amount": 500},
    {"id": "p1", "index": 1, "up_to": 25, "flat_amount": 0, "unit_amount": 300},
    {"id": "p1", "index": 2, "up_to": None, "flat_amount": None, "unit_amount": 100},
]


def _items(qs):
    return [{"id": f"i{q}", "quantity": q, "subscription_id": f"s{q}", "plan_id": "p1",
             "created": ts(2000, 1, 1)} for q in qs]


def test_tier_amounts_at_bounds_and_flat_zero(spark):
    t = billing(spark, price=[_price("p1")], tier=TIERS,
                product=[{"id": "prod_a", "name": "A"}],
                subscription_item=_items([None, 0, 5, 10, 11, 25, 26, 40]))
    out = staging.stg_subscription_item(t.subscription_item, t.price, t.product,
                                        t.product_config, t.tier)
    got = {r["price_quantity"]: r["price_amount"] for r in out.collect()}
    # q=10 exactly on the bound: whole first tier only (tier 2 not reached)
    # q in (10, 25]: first tier + flat 0; q above 25: + (q-25) * 1.00
    assert got == {None: None, 0: 0.0, 5: 25.0, 10: 50.0, 11: 50.0, 25: 50.0,
                   26: 51.0, 40: 65.0}


def test_per_unit_counted_once_per_tier_row_and_unknown_scheme(spark):
    prices = [_price("pu", "per_unit", unit=250), _price("pt", "per_unit", unit=100),
              _price("px", "odd")]
    tiers = [{"id": "pt", "index": i, "up_to": None, "unit_amount": 1} for i in range(2)]
    items = [{"id": "a", "quantity": 3, "plan_id": "pu"}, {"id": "b", "quantity": 3, "plan_id": "pt"},
             {"id": "c", "quantity": 3, "plan_id": "px"}, {"id": "d", "quantity": 3, "plan_id": "zz"}]
    t = billing(spark, price=prices, tier=tiers, subscription_item=items)
    out = staging.stg_subscription_item(t.subscription_item, t.price, t.product,
                                        t.product_config, t.tier)
    got = {r["id"]: r["price_amount"] for r in out.collect()}
    assert got == {"a": 7.5, "b": 6.0, "c": None, "d": None}


def test_repeated_and_missing_item_ids(spark):
    """Amounts are summed per item id and joined back by id: lines that share an id share
    the sum, a line without an id has no amount, whatever the size of the tables."""
    items = [{"id": "a", "quantity": 3, "plan_id": "pu"}, {"id": "a", "quantity": 5, "plan_id": "pu"},
             {"id": None, "quantity": 2, "plan_id": "pu"}, {"id": "b", "quantity": 1, "plan_id": None}]
    t = billing(spark, price=[_price("pu", "per_unit", unit=250)], subscription_item=items)
    out = staging.stg_subscription_item(t.subscription_item, t.price, t.product,
                                        t.product_config, t.tier)
    got = sorted((str(r["id"]), r["price_quantity"], r["price_amount"]) for r in out.collect())
    assert got == [("None", 2, None), ("a", 3, 20.0), ("a", 5, 20.0), ("b", 1, None)]


def test_product_config_wins_only_for_joined_product(spark):
    t = billing(spark,
                price=[_price("p1", product="prod_a"), _price("p2", product="prod_b"),
                       _price("p3", product=None), _price("p4", product="prod_missing")],
                product=[{"id": "prod_a", "name": "A"}, {"id": "prod_b", "name": "B"}],
                product_config=[{"product_id": "prod_a", "name": "Renamed",
                                 "is_main_product": False},
                                {"product_id": "prod_missing", "name": "Ghost",
                                 "is_main_product": False}])
    out = staging.stg_price(t.price, t.product, t.product_config)
    got = {r["id"]: (r["product_name"], r["is_main_product"]) for r in out.collect()}
    assert got == {"p1": ("Renamed", False), "p2": ("B", True), "p3": (None, True),
                   "p4": (None, True)}


def test_billing_cycle_labels(spark):
    prices = [_price("a", interval="month", count=1), _price("b", interval="month", count=3),
              _price("c", interval="month", count=6), _price("d", interval="year", count=1),
              _price("e", interval="year", count=2), _price("f", interval="week", count=1)]
    t = billing(spark, price=prices)
    got = {r["id"]: r["billing_cycle"]
           for r in staging.stg_price(t.price, t.product, t.product_config).collect()}
    assert got == {"a": "monthly", "b": "quarterly", "c": "biannually", "d": "annually",
                   "e": None, "f": None}


def test_plan_is_oldest_main_item_with_total_amount_and_tie_on_id(spark):
    prices = [_price("main", "per_unit", unit=1000, product="prod_m"),
              _price("addon", "per_unit", unit=100, product="prod_x")]
    cfg = [{"product_id": "prod_m", "name": "Main", "is_main_product": True},
           {"product_id": "prod_x", "name": "Addon", "is_main_product": False}]
    products = [{"id": "prod_m", "name": "m"}, {"id": "prod_x", "name": "x"}]
    items = [
        {"id": "i2", "created": ts(2000, 1, 1), "quantity": 1, "subscription_id": "s", "plan_id": "main"},
        {"id": "i1", "created": ts(2000, 1, 1), "quantity": 2, "subscription_id": "s", "plan_id": "main"},
        {"id": "i0", "created": ts(1999, 1, 1), "quantity": 5, "subscription_id": "s", "plan_id": "addon"},
        {"id": "j0", "created": ts(1999, 1, 1), "quantity": 5, "subscription_id": "t", "plan_id": "addon"},
    ]
    t = billing(spark, price=prices, product=products, product_config=cfg,
                subscription_item=items,
                subscription_history=[{"id": "s", "livemode": True, "_fivetran_active": True},
                                      {"id": "t", "livemode": True, "_fivetran_active": True}])
    si = staging.stg_subscription_item(t.subscription_item, t.price, t.product,
                                       t.product_config, t.tier)
    plans = {r["subscription_id"]: r for r in staging.main_plan(si).collect()}
    assert set(plans) == {"s"}  # t has no main item
    # tie on created_at -> lowest item id (i1, quantity 2); amount = all items
    assert plans["s"]["product_name"] == "Main"
    assert plans["s"]["plan_amount"] == 10.0 + 20.0 + 5.0
    subs = {r["id"]: r for r in staging.stg_subscription(
        t.subscription_history, staging.stg_customer(t.customer, t.card), si).collect()}
    assert subs["t"]["plan_amount"] is None and subs["t"]["product_name"] is None
    assert subs["s"]["annual_value"] == 12 * 35.0


@pytest.mark.parametrize("interval,count,expected", [
    ("month", 1, 12 * 10.0), ("month", 5, 2 * 10.0), ("month", 24, 0.0),
    ("year", 1, 10.0), ("year", 2, 0.0), ("week", 1, None)])
def test_annual_value_integer_division(spark, interval, count, expected):
    t = billing(spark, price=[_price("p", "per_unit", interval, count, 1000)],
                subscription_item=[{"id": "i", "quantity": 1, "subscription_id": "s",
                                    "plan_id": "p", "created": ts(2000, 1, 1)}],
                subscription_history=[{"id": "s", "livemode": True, "_fivetran_active": True}])
    si = staging.stg_subscription_item(t.subscription_item, t.price, t.product,
                                       t.product_config, t.tier)
    sub = staging.stg_subscription(t.subscription_history,
                                   staging.stg_customer(t.customer, t.card), si).collect()[0]
    assert sub["annual_value"] == expected


def test_customer_name_and_location_fallbacks(spark):
    t = billing(spark,
                customer=[{"id": "c1", "email": "A@B.COM", "default_card_id": "k1",
                           "balance": -1234, **LIVE},
                          {"id": "c2", "description": "d", "shipping_address_country": "FR",
                           **LIVE},
                          {"id": "c3", "livemode": False, "is_deleted": False}],
                card=[{"id": "k1", "country": "DE"}])
    got = {r["id"]: r for r in staging.stg_customer(t.customer, t.card).collect()}
    assert set(got) == {"c1", "c2"}
    assert got["c1"]["name"] == "a@b.com" and got["c1"]["country"] == "DE"
    assert got["c1"]["balance"] == -12.34
    assert got["c2"]["name"] == "d" and got["c2"]["country"] == "FR"
