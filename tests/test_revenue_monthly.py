"""Revenue recognition and monthly models on hand-sized tables."""

from __future__ import annotations

import datetime as dt

from conftest import billing, collect_sorted, ts
from pyspark.sql import functions as F

from tallyspark.operators import monthly, revenue, staging, trials

AS_OF = dt.date(2001, 6, 15)
D = dt.date


def _subs(spark, subs):
    """stg_subscription-shaped frame from partial dicts."""
    base = {"customer_name": None, "product_name": "P", "product_id": "prod",
            "plan_recurring_interval": "month", "plan_recurring_interval_count": 1,
            "cancel_at": None, "is_cancel_at_period_end": False, "current_period_end_at": None,
            "status": "active", "created_at": ts(2000, 1, 1), "trial_started_at": None,
            "trial_end_at": None}
    rows = [{**base, **s} for s in subs]
    cols = ["id", *base]
    schema = ("id string, customer_name string, product_name string, product_id string, "
              "plan_recurring_interval string, plan_recurring_interval_count bigint, "
              "cancel_at timestamp, is_cancel_at_period_end boolean, "
              "current_period_end_at timestamp, status string, created_at timestamp, "
              "trial_started_at timestamp, trial_end_at timestamp")
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schema)


def _inv(i, sub, day, cents, cust="c1", status="paid"):
    return {"id": f"in{i}", "subscription_id": sub, "period_end": day, "total": cents,
            "customer_id": cust, "status": status, "livemode": True, "is_deleted": False}


def test_annual_spread_clamps_month_ends_and_stops_at_period_end(spark):
    subs = _subs(spark, [{"id": "s", "plan_recurring_interval": "year",
                          "current_period_end_at": ts(2000, 5, 31)}])
    t = billing(spark, invoice=[_inv(1, "s", ts(2000, 1, 31), 1200)])
    got = collect_sorted(revenue.annual_spread(t.invoice, subs, AS_OF), "date")
    assert [r["date"] for r in got] == [D(2000, 1, 31), D(2000, 2, 29), D(2000, 3, 31),
                                        D(2000, 4, 30)]  # May 31 is not < May 31
    assert all(r["amount"] == 1.0 for r in got)  # 12.00 / 12


def test_annual_spread_without_period_end_runs_to_next_month(spark):
    subs = _subs(spark, [{"id": "s", "plan_recurring_interval": "year"}])
    t = billing(spark, invoice=[_inv(1, "s", ts(2001, 1, 15), 120000)])
    got = collect_sorted(revenue.annual_spread(t.invoice, subs, AS_OF), "date")
    assert [r["date"] for r in got] == [D(2001, m, 15) for m in range(1, 7)]


def test_filters_refunds_statuses_plans_and_future(spark):
    subs = _subs(spark, [{"id": "m"}, {"id": "q", "plan_recurring_interval_count": 3}])
    inv = [_inv(1, "m", ts(2001, 1, 5), 100), _inv(2, "m", ts(2001, 2, 5), -100),
           _inv(3, "m", ts(2001, 3, 5), 100, status="void"),
           _inv(4, "m", ts(2001, 4, 5), 100, status=None),
           _inv(5, "m", ts(2001, 7, 1), 100), _inv(6, "q", ts(2001, 1, 5), 100)]
    got = revenue.monthly_invoices(billing(spark, invoice=inv).invoice, subs, AS_OF).collect()
    assert [(r["date"], r["amount"]) for r in got] == [(D(2001, 1, 5), 1.0)]


def test_identical_invoices_count_once_and_expected_invoice(spark):
    subs = _subs(spark, [{"id": "a"}, {"id": "b"},
                         {"id": "c", "cancel_at": ts(2002, 1, 1)}])
    inv = [_inv(1, "a", ts(2001, 5, 3), 500), _inv(2, "a", ts(2001, 5, 3), 500),
           _inv(3, "b", ts(2001, 5, 3), 700), _inv(4, "b", ts(2001, 6, 2), 700),
           _inv(5, "c", ts(2001, 5, 3), 900)]
    t = billing(spark, invoice=inv)
    rev = collect_sorted(revenue.revenue(t.invoice, subs, AS_OF),
                         "stripe_subscription_id", "month")
    got = [(r["stripe_subscription_id"], r["month"], r["amount"], r["is_actual"]) for r in rev]
    assert got == [
        ("a", D(2001, 5, 1), 5.0, True),     # two identical invoices: once
        ("a", D(2001, 6, 1), 5.0, False),    # expected this month
        ("b", D(2001, 5, 1), 7.0, True),
        ("b", D(2001, 6, 1), 7.0, True),     # already invoiced: nothing expected
        ("c", D(2001, 5, 1), 9.0, True),     # cancelling: nothing expected
    ]
    exp = revenue.expected_invoices(t.invoice, subs, AS_OF).collect()
    # one projection per invoice; the identical pair collapses only in the union
    assert [(r["subscription_id"], r["date"]) for r in exp] == [("a", D(2001, 6, 3))] * 2


def _revenue_rows(spark, rows):
    """revenue-shaped frame: (customer, month, amount)."""
    return spark.createDataFrame(
        [(c, m, m, a) for c, m, a in rows],
        "stripe_customer_id string, recognized_at date, month date, amount double")


def test_waterfall_reactivation_gap_and_null_customer(spark):
    rev = _revenue_rows(spark, [
        ("c1", D(2001, 1, 1), 10.0), ("c1", D(2001, 2, 1), 12.0), ("c1", D(2001, 3, 1), 9.0),
        ("c1", D(2001, 5, 1), 9.0),              # back after a gap: new again
        ("c2", D(2000, 10, 1), 5.0),             # alone in 2000-10, churns in 2000-11
        (None, D(2001, 1, 1), 100.0),            # no customer id: never counted
    ])
    arr = {r["month"]: r for r in monthly.monthly_arr(monthly.customer_months(rev), AS_OF).collect()}
    # 2000-12 lies in no customer's span: no row at all
    assert sorted(arr) == [D(2000, 10, 1), D(2000, 11, 1), D(2001, 1, 1), D(2001, 2, 1),
                           D(2001, 3, 1), D(2001, 4, 1), D(2001, 5, 1), D(2001, 6, 1)]
    assert arr[D(2000, 11, 1)]["churn_arr"] == -60.0 and arr[D(2000, 11, 1)]["new_arr"] == 0.0
    assert arr[D(2000, 11, 1)]["ending_arr"] is None
    assert arr[D(2001, 2, 1)]["expansion_arr"] == 24.0
    assert arr[D(2001, 3, 1)]["contraction_arr"] == -36.0
    assert arr[D(2001, 4, 1)]["churn_arr"] == -108.0
    assert arr[D(2001, 5, 1)]["new_arr"] == 108.0
    assert arr[D(2001, 6, 1)]["churn_arr"] == 0.0  # not booked in the as-of month
    # beginning = previous *row's* ending (2000-12 has no row at all)
    assert arr[D(2001, 1, 1)]["beginning_arr"] is None  # 2000-11 ending is NULL
    cust = {r["month"]: r for r in monthly.monthly_customers(monthly.customer_months(rev), AS_OF).collect()}
    assert cust[D(2000, 10, 1)]["beginning_customers"] == 0
    assert cust[D(2001, 4, 1)]["churn_customers"] == -1
    assert cust[D(2001, 5, 1)]["new_customers"] == 1
    assert cust[D(2001, 1, 1)]["ending_customers"] == 1


def test_customer_months_matches_reference_null_month_row(spark):
    rev = _revenue_rows(spark, [(None, D(2001, 1, 1), 1.0), (None, D(2001, 3, 1), 2.0),
                                ("c", D(2001, 1, 1), 4.0)])
    rows = collect_sorted(monthly.customer_month_lag_lead(monthly.customer_months(rev)), "stripe_customer_id", "month")
    got = [(r["stripe_customer_id"], r["month"], r["total_in_month"],
            r["total_previous_month"], r["total_next_month"])
           for r in rows]
    assert got == [
        ("c", D(2001, 1, 1), 4.0, None, None), ("c", D(2001, 2, 1), None, 4.0, None),
        (None, D(2001, 1, 1), None, None, None), (None, D(2001, 2, 1), None, None, None),
        (None, D(2001, 3, 1), None, None, None), (None, D(2001, 4, 1), None, None, 3.0),
        (None, None, 3.0, None, None),
    ]


def test_waterfall_identity_on_derived_data(spark):
    """beginning + new + expansion + contraction + churn = ending, for months whose
    previous row is the previous calendar month (NULL as 0)."""
    from conftest import SF_SMALL

    from tallyspark.plans import ModelSet
    from tallyspark.sources import derive_billing_tables
    ms = ModelSet(derive_billing_tables(spark, SF_SMALL), AS_OF)
    arr = collect_sorted(ms.model("monthly_arr"), "month")
    z = lambda v: v or 0.0
    checked = 0
    for prev, cur in zip(arr, arr[1:]):
        m = cur["month"]
        if (prev["month"].year * 12 + prev["month"].month + 1 == m.year * 12 + m.month
                and m < D(2001, 6, 1)):
            total = sum(z(cur[c]) for c in ["beginning_arr", "new_arr", "expansion_arr",
                                             "contraction_arr", "churn_arr"])
            assert abs(total - z(cur["ending_arr"])) < 1e-6
            checked += 1
    assert checked > 50
    cust = collect_sorted(ms.model("monthly_customers"), "month")
    for r in cust:
        if r["month"] < D(2001, 6, 1):
            assert (r["beginning_customers"] + r["new_customers"] + r["churn_customers"]
                    == r["ending_customers"])
    # spread instalments: at most 12 per annual invoice, never more than its total
    subs = ms.model("stg_subscription")
    ann = (revenue.annual_invoices(ms.tables.invoice, subs, AS_OF)
           .groupBy("subscription_id").agg(F.count("*").alias("n"), F.sum("amount").alias("t")))
    spr = (revenue.annual_spread(ms.tables.invoice, subs, AS_OF)
           .groupBy("subscription_id").agg(F.count("*").alias("k"), F.sum("amount").alias("s")))
    j = ann.join(spr, "subscription_id")
    assert j.count() > 0
    assert j.where((F.col("k") > 12 * F.col("n")) | (F.col("s") > F.col("t") + 1e-6)).count() == 0


def test_trial_calendar_running_day_and_no_cancel(spark):
    subs = _subs(spark, [
        {"id": "a", "created_at": ts(2000, 1, 31), "cancel_at": ts(2000, 2, 28)},
    ])
    # start Jan 31 -> Feb 29 -> Mar 29 (running day), stop Mar 28: March excluded
    cal = [r["dt"] for r in collect_sorted(trials.trial_calendar(subs), "dt")]
    assert cal == [D(2000, 1, 1), D(2000, 2, 1)]
    subs2 = _subs(spark, [{"id": "a", "created_at": ts(2000, 1, 10)}])
    assert trials.trial_calendar(subs2).count() == 0  # nobody cancelled
    subs3 = _subs(spark, [{"id": "a", "created_at": ts(2000, 1, 10),
                           "cancel_at": ts(2000, 2, 10)}])
    cal3 = [r["dt"] for r in collect_sorted(trials.trial_calendar(subs3), "dt")]
    assert cal3 == [D(2000, 1, 1), D(2000, 2, 1), D(2000, 3, 1)]


def test_trial_conversion_reads_raw_timestamps(spark):
    subs = _subs(spark, [
        {"id": "a", "trial_started_at": ts(2001, 1, 3), "trial_end_at": ts(2001, 1, 17),
         "cancel_at": dt.datetime(2001, 1, 17, 12)},
        {"id": "b", "trial_started_at": ts(2001, 1, 5), "trial_end_at": ts(2001, 1, 19)},
        {"id": "c", "trial_started_at": ts(2001, 1, 5), "status": "trialing"},
    ])
    facts = {r["subscription_id"]: r for r in trials.trial_facts(subs).collect()}
    assert set(facts) == {"a", "b"}
    assert facts["a"]["is_converted"] is True   # same day, earlier time
    assert facts["b"]["is_converted"] is True   # never cancelled
    mt = {r["month_started_trial"]: r for r in trials.monthly_trialers(subs, AS_OF).collect()}
    assert mt[D(2001, 1, 1)]["num_converted_post_trial"] == 2
    assert mt[D(2001, 1, 1)]["trial_conversion_rate"] == 1.0


def test_stg_invoice_units_and_names(spark):
    t = billing(spark, invoice=[_inv(1, "s", ts(2001, 1, 5), 1999, cust="c1")],
                customer=[{"id": "c1", "name": "N", "livemode": True, "is_deleted": False}])
    subs = _subs(spark, [{"id": "s", "product_name": "Prod"}])
    got = staging.stg_invoice(t.invoice, staging.stg_customer(t.customer, t.card), subs).collect()
    assert [(r["customer_name"], r["product_name"], r["total"]) for r in got] == [
        ("N", "Prod", 19.99)]
