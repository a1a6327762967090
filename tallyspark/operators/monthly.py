"""Monthly models: per-customer month spine, ARR waterfall and customer counts.

The reference builds, per customer, every month from its first to its last
revenue month plus one (the extra month exposes churn), full-outer-joins revenue
onto that spine, and takes ``lag``/``lead`` per customer. Here the same rows
come out of one window over the (customer, month) totals: each active month
row is exploded into itself plus the empty months that follow it up to the next
active month (or one month for the last). The previous/next totals of every
spine month follow from the neighbouring active months, so no spine table and
no join is needed. Plan: one scan of revenue -> partial aggregate by (customer, month) ->
shuffle -> shuffle by customer for the window -> explode (map side) -> partial
aggregate by month -> a global window over one row per month. No join.

Skew: a customer with a third of all revenue rows is reduced to one row per
month by the map-side partial aggregate before any shuffle by customer, so the
per-customer window sees at most "number of months" rows per customer.

Amounts are exact integers in twelfths of a cent (monthly revenue × 1200); ARR
(= 12 × monthly revenue) in cents is that same integer.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.dates import as_of_month, lit_date, month_start
from tallyspark.functions.money import to_twelfths, twelfths_to_units

CUST = "stripe_customer_id"


# ------------------------------------------------------------------ spine

def customer_months(revenue: DataFrame) -> DataFrame:
    """One row per spine month with ``total``, ``previous`` and ``next`` totals
    (twelfths of a cent; NULL = no revenue that month), and the customer's first and
    last revenue month. The models below take this table, which a model set builds once.

    Equal to the reference's spine ⟗ revenue grouped by (month, customer) with
    ``lag``/``lead`` per customer ordered by month (NULLs last), including its
    two quirks for revenue without a customer id: the NULL customer's spine months
    all have NULL totals (NULL never matches in the join), and its revenue forms
    one extra row with a NULL month, ordered after that customer's last month.
    """
    known = F.col(CUST).isNotNull()
    w = Window.partitionBy(CUST).orderBy(F.col("month").asc_nulls_last())
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # the NULL customer's months carry no total (NULL never matches the spine)
    cm = (revenue.groupBy(CUST, month_start("recognized_at").alias("month"))
          .agg(F.sum(to_twelfths("amount")).alias("_raw"))
          .withColumn("_t", F.when(known, F.col("_raw"))))
    # one Window operator: neighbours by month, and the customer's whole total
    cm = cm.select(CUST, "month", "_t",
                   F.lag("month").over(w).alias("_pm"), F.lag("_t").over(w).alias("_pt"),
                   F.lead("month").over(w).alias("_nm"), F.lead("_t").over(w).alias("_nt"),
                   F.sum("_raw").over(whole).alias("_all"),
                   F.min("month").over(whole).alias("first_month"),
                   F.max("month").over(whole).alias("last_month"))

    # each active month row stands for itself and the empty months up to the next
    # active month; the last one also for the month after it (the churn month), and
    # the NULL customer's last one also for the NULL-month row of its whole revenue
    last = F.col("_nm").isNull()
    orphan_tail = ~known & last
    n = (F.when(last, F.when(known, F.lit(2)).otherwise(F.lit(3)))
         .otherwise(F.months_between("_nm", "month").cast("int")))
    j = F.col("_j")
    null_row = orphan_tail & (j == 2)
    month = F.when(null_row, F.lit(None).cast("date")).otherwise(F.add_months("month", j))
    total = F.when(j == 0, F.col("_t")).when(null_row, F.col("_all"))
    previous = (F.when(j == 0, F.when(F.col("_pm") == F.add_months("month", -1), F.col("_pt")))
                .when(j == 1, F.col("_t")))
    nxt = (F.when(F.add_months("month", j + 1) == F.col("_nm"), F.col("_nt"))
           .when(orphan_tail & (j == 1), F.col("_all")))
    return (cm.select("*", F.explode(F.sequence(F.lit(0), n - 1)).alias("_j"))
            .select(month.alias("month"), CUST, total.alias("total"),
                    previous.alias("previous"), nxt.alias("next"),
                    "first_month", "last_month"))


def customer_span(months: DataFrame) -> DataFrame:
    """First and last revenue month per customer (the NULL customer is a group too)."""
    return months.select(CUST, "first_month", "last_month").distinct()


def customer_month_spine(months: DataFrame) -> DataFrame:
    """Every month from a customer's first revenue month to its last plus one."""
    return months.where(F.col("month").isNotNull()).select(CUST, "first_month", "last_month",
                                                           "month")


def customer_month_totals(months: DataFrame) -> DataFrame:
    """Revenue per customer and spine month (NULL = inactive month), in units."""
    return months.select(
        "month", CUST, twelfths_to_units("total").alias("total_in_month"))


def customer_month_lag_lead(months: DataFrame) -> DataFrame:
    """``customer_month_totals`` with the previous and next month's totals."""
    return months.select(
        "month", CUST,
        twelfths_to_units("total").alias("total_in_month"),
        twelfths_to_units("previous").alias("total_previous_month"),
        twelfths_to_units("next").alias("total_next_month"))


# ------------------------------------------------------------------ ARR

def _movements(months: DataFrame, as_of: dt.date) -> DataFrame:
    """Classify every customer-month (twelfths). New means "previous month empty",
    so a customer back after a gap is new again; churn is not booked in the
    as-of month."""
    cur, prev = F.col("total"), F.col("previous")
    return months.select(
        "month", CUST,
        F.coalesce(prev, F.lit(0)).alias("beginning_rev"),
        cur.alias("ending_rev"),
        F.col("next").alias("total_next_month"),
        F.when(prev.isNull(), cur).otherwise(F.lit(0)).alias("new_rev"),
        F.when(prev < cur, cur - prev).otherwise(F.lit(0)).alias("expansion_rev"),
        F.when(prev > cur, cur - prev).otherwise(F.lit(0)).alias("contraction_rev"),
        F.when((F.col("month") < lit_date(as_of_month(as_of))) & prev.isNotNull() & cur.isNull(),
               -prev).otherwise(F.lit(0)).alias("churn_rev"),
    )


_MOVES = ["beginning_rev", "ending_rev", "total_next_month", "new_rev", "expansion_rev",
          "contraction_rev", "churn_rev"]


def arr_movements(months: DataFrame, as_of: dt.date) -> DataFrame:
    """Per customer-month movement amounts (units of monthly revenue)."""
    mv = _movements(months, as_of)
    return mv.select("month", CUST, *[twelfths_to_units(c).alias(c) for c in _MOVES])


def _rollup(movements: DataFrame) -> DataFrame:
    """Sum movements per month; beginning = previous month row's summed ending.

    The global window sees one row per month only.
    """
    w = Window.orderBy(F.col("month").asc_nulls_last())
    agg = movements.groupBy("month").agg(
        *[F.sum(c).alias(c) for c in ["new_rev", "expansion_rev", "contraction_rev",
                                       "churn_rev", "ending_rev"]])
    return agg.select("month", "new_rev", "expansion_rev", "contraction_rev", "churn_rev",
                      F.lag("ending_rev").over(w).alias("beginning_rev"), "ending_rev")


def arr_monthly_rollup(months: DataFrame, as_of: dt.date) -> DataFrame:
    r = _rollup(_movements(months, as_of))
    return r.select("month", *[twelfths_to_units(c).alias(c) for c in r.columns[1:]])


MONTHLY_ARR_COLUMNS = ["month", "beginning_arr", "new_arr", "expansion_arr", "contraction_arr",
                       "churn_arr", "ending_arr"]


def monthly_arr(months: DataFrame, as_of: dt.date) -> DataFrame:
    """Monthly ARR waterfall (ARR = 12 × monthly revenue) up to the as-of month.

    The lag for ``beginning`` is taken before the month filter, as in the reference.
    """
    r = _rollup(_movements(months, as_of))
    arr = lambda c: (F.col(c).cast("double") / 100).alias(c.replace("_rev", "_arr"))
    return (r.where(F.col("month") <= lit_date(as_of_month(as_of)))
            .select("month", arr("beginning_rev"), arr("new_rev"), arr("expansion_rev"),
                    arr("contraction_rev"), arr("churn_rev"), arr("ending_rev")))


# ------------------------------------------------------------------ customers

def _status(months: DataFrame, as_of: dt.date) -> DataFrame:
    cur, prev = F.col("total"), F.col("previous")
    return months.select(
        "month", CUST,
        (prev.isNull() & (cur > 0)).alias("is_new"),
        ((F.col("month") < lit_date(as_of_month(as_of))) & prev.isNotNull() & cur.isNull())
        .alias("is_churn"),
        (cur.isNotNull() & (cur > 0)).alias("is_paid"),
        (prev.isNotNull() & cur.isNotNull()).alias("is_retained"),
    )


def customer_status(months: DataFrame, as_of: dt.date) -> DataFrame:
    """New / churned / paying / retained flags per customer-month."""
    return _status(months, as_of)


def _count(flag: str) -> Column:
    # rows are unique per (month, customer), so a distinct count of customers with
    # the flag is a plain count of flagged rows with a known customer
    return F.count_if(F.col(flag) & F.col(CUST).isNotNull())


def _customer_rollup(status: DataFrame) -> DataFrame:
    return status.groupBy("month").agg(
        _count("is_new").alias("new_customers"),
        (-_count("is_churn")).alias("churn_customers"),
        _count("is_paid").alias("ending_customers"),
        _count("is_retained").alias("retained_customers"),
    )


def customer_monthly_rollup(months: DataFrame, as_of: dt.date) -> DataFrame:
    """Distinct customers per flag and month; churn negated."""
    return _customer_rollup(_status(months, as_of))


def monthly_customers(months: DataFrame, as_of: dt.date) -> DataFrame:
    """Monthly customer counts up to the as-of month; the month filter runs *before*
    the lag, and the first month begins at 0."""
    r = _customer_rollup(_status(months, as_of))
    w = Window.orderBy(F.col("month").asc_nulls_last())
    return (r.where(F.col("month") <= lit_date(as_of_month(as_of)))
            .select("month",
                    F.coalesce(F.lag("ending_customers").over(w), F.lit(0))
                    .alias("beginning_customers"),
                    "new_customers", "churn_customers", "ending_customers"))
