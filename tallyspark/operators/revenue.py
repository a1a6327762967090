"""Revenue recognition: invoices -> one revenue row per subscription and month.

Amounts inside this module are exact integers in **twelfths of a cent** (see
``tallyspark.functions.money``); the public functions convert to double units.

Inputs: ``invoice`` is the raw invoice table (money in cents); ``subscriptions``
is ``stg_subscription``. The reference reads ``stg_invoice`` here, whose extra
customer/subscription joins only add names revenue never reads; joins cannot
add new distinct revenue rows, so the narrow live-invoice scan gives the same
result without two large joins.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.dates import add_months, as_of_month, lit_date, lit_ts, month_start
from tallyspark.functions.money import cents_to_units, twelfths_to_units
from tallyspark.operators.staging import live_invoices

EXCLUDED_STATUSES = ("uncollectible", "void", "deleted")

BRANCH_COLUMNS = [
    "recognized_at", "billing_cycle", "product_name", "is_actual", "is_auto_renewal", "amount",
    "stripe_customer_id", "stripe_subscription_id", "customer_name", "stripe_product_id",
]

def auto_renewal_flag(cancel_at: Column, cancel_at_period_end: Column) -> Column:
    """Renews by itself: no cancel date and not cancelling at period end (NULL-able)."""
    return cancel_at.isNull() & ~cancel_at_period_end


def _billable(invoice: DataFrame, subscriptions: DataFrame, as_of: dt.date,
              since: dt.date | None = None) -> DataFrame:
    """Positive, collectible invoices up to the as-of month, joined to subscriptions on a
    monthly or yearly plan (one join, shared by both plan kinds).

    The month bounds are written on the raw timestamp (``period_end < next month``,
    and ``>= since`` when given) so they are pushed into the Parquet scan and can
    skip row groups / partitions.
    """
    next_month = lit_ts(add_months(as_of_month(as_of), 1))
    window = F.col("period_end") < next_month
    if since is not None:
        window = window & (F.col("period_end") >= lit_ts(since))
    inv = (live_invoices(invoice)
           .where((F.col("total") > 0) & ~F.col("status").isin(*EXCLUDED_STATUSES) & window)
           .select(F.col("total").alias("cents"),
                   F.to_date("period_end").alias("date"),
                   F.col("subscription_id").alias("_inv_sub_id"),
                   F.col("customer_id").alias("stripe_customer_id")))
    subs = (subscriptions
            .where(F.col("plan_recurring_interval").isin("month", "year")
                   & (F.col("plan_recurring_interval_count") == 1))
            .select(F.col("id").alias("subscription_id"),
                    "customer_name",
                    auto_renewal_flag(F.col("cancel_at"), F.col("is_cancel_at_period_end"))
                    .alias("is_auto_renewal"),
                    "product_id", "product_name",
                    F.col("plan_recurring_interval").alias("_interval"),
                    F.col("current_period_end_at").alias("subscription_period_end")))
    return inv.join(subs, F.col("_inv_sub_id") == F.col("subscription_id")).drop("_inv_sub_id")


# ------------------------------------------------------------------ internal (twelfths)

def _instalments(billable: DataFrame, as_of: dt.date) -> DataFrame:
    """Monthly invoices and annual instalments in one pass over the billable invoices:
    a monthly invoice yields itself (k = 0); an annual one twelve instalments of
    ``amount/12`` (= ``cents`` twelfths), instalment k kept while ``date + k months`` is
    before the period end (or, without one, before next month). ``add_months`` from the
    original date clamps to month ends."""
    monthly = F.col("_interval") == "month"
    k = F.col("_k")
    inst_date = F.add_months("date", k)
    fallback_end = lit_ts(add_months(as_of_month(as_of), 1))
    last_k = F.when(monthly, F.lit(0)).otherwise(F.lit(11))
    return (billable.select("*", F.explode(F.sequence(F.lit(0), last_k)).alias("_k"))
            .where(monthly | (inst_date.cast("timestamp")
                              < F.coalesce(F.col("subscription_period_end"), fallback_end)))
            .select(inst_date.alias("date"),
                    F.when(monthly, F.lit("monthly")).otherwise(F.lit("annually"))
                    .alias("billing_cycle"),
                    "product_name",
                    F.when(monthly, F.col("cents") * 12).otherwise(F.col("cents"))
                    .alias("amount"),
                    "is_auto_renewal", "stripe_customer_id", "subscription_id",
                    "customer_name", "product_id"))


def _monthly(billable: DataFrame, as_of: dt.date) -> DataFrame:
    return (_instalments(billable.where(F.col("_interval") == "month"), as_of)
            .select("amount", "date", "subscription_id", "customer_name", "is_auto_renewal",
                    "product_id", "product_name", "billing_cycle", "stripe_customer_id"))


def _expected(invoice: DataFrame, subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """Auto-renewing subscriptions invoiced last month but not (yet) this month:
    last month's invoice, projected one month on.

    One read of the last two months (a range predicate on the invoice scan). Equal invoices are
    counted together, and so are all of this month's of a subscription, before any shuffle;
    whether a subscription was invoiced this month is then one flag over its few rows.
    """
    this_m = as_of_month(as_of)
    last_m = add_months(this_m, -1)
    recent = _monthly(_billable(invoice, subscriptions, as_of, since=last_m), as_of)
    is_this = month_start("date") == lit_date(this_m)
    kept = [c for c in recent.columns if c != "subscription_id"]
    rows = (recent.where(is_this | F.col("is_auto_renewal"))
            .groupBy("subscription_id", is_this.alias("_this"),
                     *[F.when(~is_this, F.col(c)).alias(c) for c in kept])
            .agg(F.count(F.lit(1)).cast("int").alias("_n")))
    invoiced = F.max("_this").over(Window.partitionBy("subscription_id"))
    return (rows.withColumn("_invoiced", invoiced).where(~F.col("_invoiced"))
            .select("*", F.explode(F.array_repeat(F.lit(0), F.col("_n"))))
            .select("amount", F.add_months("date", 1).alias("date"), "product_id",
                    "product_name", "billing_cycle", "stripe_customer_id", "subscription_id",
                    "customer_name", "is_auto_renewal"))


def _annual(billable: DataFrame) -> DataFrame:
    return billable.where(F.col("_interval") == "year").select(
        F.col("cents").alias("amount"), "date", "subscription_period_end", "subscription_id",
        "customer_name", "is_auto_renewal", "product_id", "product_name",
        F.lit("annually").alias("billing_cycle"), "stripe_customer_id")


def _branch(df: DataFrame, is_actual: bool, deal: bool = False) -> DataFrame:
    """Project to the union's columns and drop exact duplicates (after the instalments: month
    ends make some of them equal).

    The constant ``is_actual`` joins the rows last: a partitioning that names it is not one of
    the ``distinct``, and every row would move once more. ``deal``: the rows are dealt by all
    their columns first, so that the join above is a stage of its own.
    """
    rows = df.select(
        F.col("date").alias("recognized_at"), "billing_cycle", "product_name",
        "is_auto_renewal", "amount", "stripe_customer_id",
        F.col("subscription_id").alias("stripe_subscription_id"), "customer_name",
        F.col("product_id").alias("stripe_product_id"))
    if deal:
        rows = rows.repartition(*rows.columns)
    return rows.distinct().select("*", F.lit(is_actual).alias("is_actual")).select(
        *BRANCH_COLUMNS)


def _union(invoice: DataFrame, subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """The three revenue branches, each without duplicate rows. Monthly and annual rows
    come from one read (they never are equal: their billing cycles differ); the expected
    branch reads two months.

    Both branches lie by subscription, so that neither the instalments (up to twelve rows of
    an invoice) nor the union move again before they are consolidated. A hot subscription is
    split all the same: adaptive execution may then add exchanges behind the split join
    (``forceOptimizeSkewedJoin``, :mod:`tallyspark.session`), the first of them by all columns.
    """
    actual = _instalments(_billable(invoice, subscriptions, as_of), as_of)
    expected = _branch(_expected(invoice, subscriptions, as_of), False, deal=True)
    return _branch(actual, True).unionByName(expected.repartition("stripe_subscription_id"))


def _consolidate(union: DataFrame) -> DataFrame:
    """One row per (month, subscription): amounts summed, the rest by max / any-true,
    partially in every task before the shuffle."""
    return (union.groupBy(month_start("recognized_at").alias("_month"), "stripe_subscription_id")
            .agg(F.max("recognized_at").alias("recognized_at"),
                 F.max("billing_cycle").alias("billing_cycle"),
                 F.max("product_name").alias("product_name"),
                 F.bool_or("is_actual").alias("is_actual"),
                 F.bool_or("is_auto_renewal").alias("is_auto_renewal"),
                 F.sum("amount").alias("amount"),
                 F.max("stripe_customer_id").alias("stripe_customer_id"),
                 F.max("customer_name").alias("customer_name"),
                 F.max("stripe_product_id").alias("stripe_product_id"))
            .select(*BRANCH_COLUMNS))


def _units(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", twelfths_to_units("amount"))


# ------------------------------------------------------------------ public models

def monthly_invoices(invoice: DataFrame, subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    return _units(_monthly(_billable(invoice, subscriptions, as_of), as_of))


def expected_invoices(invoice: DataFrame, subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    return _units(_expected(invoice, subscriptions, as_of))


def annual_invoices(invoice: DataFrame, subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    # an annual invoice's own amount is in cents (its instalments are twelfths)
    return (_annual(_billable(invoice, subscriptions, as_of))
            .withColumn("amount", cents_to_units("amount")))


def annual_spread(invoice: DataFrame, subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    billable = _billable(invoice, subscriptions, as_of).where(F.col("_interval") == "year")
    return _units(_instalments(billable, as_of)).withColumn("is_actual", F.lit(True))


def monthly_revenue_union(invoice: DataFrame, subscriptions: DataFrame,
                          as_of: dt.date) -> DataFrame:
    return _units(_union(invoice, subscriptions, as_of))


def consolidated_revenue(invoice: DataFrame, subscriptions: DataFrame,
                         as_of: dt.date) -> DataFrame:
    return _units(_consolidate(_union(invoice, subscriptions, as_of)))


def revenue(invoice: DataFrame, subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """Recognised revenue, one row per subscription and month up to the as-of month.

    Rows from next month on are dropped *before* consolidation: every row of a
    (month, subscription) group shares the month, so this equals filtering the
    consolidated ``recognized_at``. Consolidated rows are unique per
    (month, subscription), so the reference's final ``distinct`` is a no-op.
    """
    next_month = lit_date(add_months(as_of_month(as_of), 1))
    union = _union(invoice, subscriptions, as_of).where(F.col("recognized_at") < next_month)
    return _units(_consolidate(union)).select(
        F.md5(F.concat_ws("", F.col("recognized_at").cast("string"),
                          F.col("stripe_subscription_id"))).alias("id"),
        "customer_name", "recognized_at",
        month_start("recognized_at").alias("month"),
        "amount", "is_actual", "is_auto_renewal", "product_name", "billing_cycle",
        "stripe_customer_id", "stripe_subscription_id", "stripe_product_id",
    )
