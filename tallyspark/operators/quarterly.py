"""Quarterly roll-ups of the monthly ARR, customer and trial models.

Inputs have one row per month, so the global (un-partitioned) windows here run
over a few hundred rows at most, whatever the data size. ARR amounts are summed
as exact cents; rates divide exact integers (NULL on a zero denominator).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.dates import as_of_quarter, lit_date, quarter_label, quarter_start
from tallyspark.functions.money import cents_to_units, ratio, to_cents



def _by(col: str):
    """Global order window (one row per month or quarter, so one small partition)."""
    return Window.orderBy(F.col(col).asc_nulls_last())


def with_quarter(df: DataFrame, month_col: str = "month") -> DataFrame:
    """Add ``quarter_name`` ('Qn YYYY') and ``quarter`` (its first day)."""
    return df.withColumns({"quarter_name": quarter_label(month_col),
                           "quarter": quarter_start(month_col)})


def _quarter_ends(monthly: DataFrame, value: str) -> DataFrame:
    """Rows that are the last month of their quarter: the *next row's* quarter
    differs. The very last month has no next row and is dropped."""
    q = with_quarter(monthly)
    return (q.select("quarter_name", "quarter", "month", value,
                     F.lead(quarter_start("month")).over(_by("month")).alias("next_quarter"))
            .where(F.col("quarter") != F.col("next_quarter")))


def _begin_end(monthly: DataFrame, value: str, begin: str) -> DataFrame:
    """Quarter-end values with the previous kept quarter's value as beginning."""
    return _quarter_ends(monthly, value).select(
        "quarter_name", "quarter", F.lag(value).over(_by("quarter")).alias(begin), value)


# ------------------------------------------------------------------ ARR

_ARR_CHANGES = ["new_arr", "expansion_arr", "contraction_arr", "churn_arr"]


def _arr_cents(monthly_arr: DataFrame) -> DataFrame:
    return monthly_arr.select("month", *[to_cents(c).alias(c) for c in monthly_arr.columns
                                         if c != "month"])


def quarter_end_arr(monthly_arr: DataFrame) -> DataFrame:
    return _quarter_ends(monthly_arr, "ending_arr")


def quarter_begin_arr(monthly_arr: DataFrame) -> DataFrame:
    return _begin_end(monthly_arr, "ending_arr", "beginning_arr")


def _arr_changes(cents: DataFrame) -> DataFrame:
    return (with_quarter(cents).groupBy("quarter_name", "quarter")
            .agg(*[F.sum(c).alias(c) for c in _ARR_CHANGES]))


def quarter_arr_changes(monthly_arr: DataFrame) -> DataFrame:
    c = _arr_changes(_arr_cents(monthly_arr))
    return c.select("quarter_name", "quarter", *[cents_to_units(x).alias(x) for x in _ARR_CHANGES])


def _arr_joined(monthly_arr: DataFrame) -> DataFrame:
    cents = _arr_cents(monthly_arr)
    j = _arr_changes(cents).join(_begin_end(cents, "ending_arr", "beginning_arr"),
                                 ["quarter_name", "quarter"], "full")
    return j.select("quarter_name", "quarter", "beginning_arr", *_ARR_CHANGES, "ending_arr",
                    F.lag("ending_arr", 4).over(_by("quarter")).alias("last_year_arr"))


def quarter_arr_joined(monthly_arr: DataFrame) -> DataFrame:
    j = _arr_joined(monthly_arr)
    return j.select("quarter_name", "quarter",
                    *[cents_to_units(c).alias(c) for c in j.columns[2:]])


QUARTERLY_ARR_COLUMNS = [
    "quarter_name", "quarter", "beginning_arr", "new_arr", "expansion_arr", "contraction_arr",
    "churn_arr", "ending_arr", "yearly_growth_rate", "quarterly_growth_rate", "expansion_rate",
    "contraction_rate",
]


def quarterly_arr(monthly_arr: DataFrame, as_of: dt.date) -> DataFrame:
    """Quarterly ARR waterfall with growth rates, completed quarters only
    (the four-quarter lag is taken before that filter)."""
    j = _arr_joined(monthly_arr)
    b, e, ly = F.col("beginning_arr"), F.col("ending_arr"), F.col("last_year_arr")
    return (j.where(F.col("quarter") < lit_date(as_of_quarter(as_of)))
            .select("quarter_name", "quarter",
                    *[cents_to_units(c).alias(c) for c in
                      ["beginning_arr", *_ARR_CHANGES, "ending_arr"]],
                    ratio(e - ly, ly).alias("yearly_growth_rate"),
                    ratio(e - b, b).alias("quarterly_growth_rate"),
                    ratio(F.col("expansion_arr"), b).alias("expansion_rate"),
                    ratio(-F.col("contraction_arr"), b).alias("contraction_rate")))


# ------------------------------------------------------------------ customers

def quarter_end_customers(monthly_customers: DataFrame) -> DataFrame:
    return _quarter_ends(monthly_customers, "ending_customers")


def quarter_begin_customers(monthly_customers: DataFrame) -> DataFrame:
    return _begin_end(monthly_customers, "ending_customers", "beginning_customers")


def _avg_in_month_order(value: Column, month: Column) -> Column:
    """Mean of ``value`` over the (at most three) months of a quarter, added in
    calendar order, so the floating-point result does not depend on how rows
    reach the aggregate."""
    pos = (F.month(month) - 1) % 3 + 1  # 1, 2, 3 within the quarter
    parts = [F.coalesce(F.sum(F.when(pos == k, value)), F.lit(0.0)) for k in (1, 2, 3)]
    return ((parts[0] + parts[1]) + parts[2]) / F.count(value) + F.lit(0.0)


def quarter_customer_changes(monthly_customers: DataFrame) -> DataFrame:
    """Sums of new and churned customers; mean monthly churn rate
    (churned ÷ beginning, a zero beginning counting as 1)."""
    churn, begin = F.col("churn_customers"), F.col("beginning_customers")
    rate = (-churn).cast("double") / F.when(begin == 0, F.lit(1)).otherwise(begin)
    return (with_quarter(monthly_customers).groupBy("quarter_name", "quarter")
            .agg(F.sum("new_customers").alias("new_customers"),
                 F.sum("churn_customers").alias("churn_customers"),
                 _avg_in_month_order(rate, F.col("month")).alias("avg_monthly_churn")))


def quarter_customers_joined(monthly_customers: DataFrame) -> DataFrame:
    j = quarter_customer_changes(monthly_customers).join(
        _begin_end(monthly_customers, "ending_customers", "beginning_customers"),
        ["quarter_name", "quarter"], "full")
    return j.select("quarter_name", "quarter", "beginning_customers", "new_customers",
                    "churn_customers", "ending_customers", "avg_monthly_churn",
                    F.lag("ending_customers", 4).over(_by("quarter")).alias("last_year_customers"))


def quarterly_customers(monthly_customers: DataFrame, as_of: dt.date) -> DataFrame:
    """Quarterly customer counts with growth rates, completed quarters only."""
    j = quarter_customers_joined(monthly_customers)
    b, e, ly = F.col("beginning_customers"), F.col("ending_customers"), F.col("last_year_customers")
    return (j.where(F.col("quarter") < lit_date(as_of_quarter(as_of)))
            .select("quarter_name", "quarter", "beginning_customers", "new_customers",
                    "churn_customers", "ending_customers", "avg_monthly_churn",
                    ratio(e - ly, ly).alias("yearly_growth_rate"),
                    ratio(e - b, b).alias("quarterly_growth_rate")))


# ------------------------------------------------------------------ trials

def quarter_trial_sums(monthly_trialers: DataFrame) -> DataFrame:
    m = F.col("month_started_trial")
    return (monthly_trialers.groupBy(quarter_start(m).alias("quarter"),
                                     quarter_label(m).alias("quarter_name"))
            .agg(F.sum("num_not_converted_post_trial").alias("num_not_converted_post_trial"),
                 F.sum("num_converted_post_trial").alias("num_converted_post_trial"))
            .withColumn("num_trialers", F.col("num_not_converted_post_trial")
                        + F.col("num_converted_post_trial")))


def quarter_trial_rates(monthly_trialers: DataFrame, as_of: dt.date) -> DataFrame:
    """Conversion rate (a zero denominator counts as 1) and the previous quarter's
    trialers; completed quarters only, filtered *before* the lag."""
    s = quarter_trial_sums(monthly_trialers)
    n = F.col("num_trialers")
    return (s.where(F.col("quarter") < lit_date(as_of_quarter(as_of)))
            .select("*",
                    (F.col("num_converted_post_trial").cast("double")
                     / F.when(n == 0, F.lit(1)).otherwise(n)).alias("trial_conversion_rate"),
                    F.lag("num_trialers").over(_by("quarter")).alias("num_trialers_previous_quarter")))


def quarterly_trialers(monthly_trialers: DataFrame, as_of: dt.date) -> DataFrame:
    r = quarter_trial_rates(monthly_trialers, as_of)
    n, p = F.col("num_trialers"), F.col("num_trialers_previous_quarter")
    return r.select("quarter", "quarter_name", "num_not_converted_post_trial",
                    "num_converted_post_trial", "num_trialers", "trial_conversion_rate",
                    ((n - p).cast("double") / F.when(p == 0, F.lit(1)).otherwise(p)
                     + F.lit(0.0)).alias("quarterly_growth_rate"))
