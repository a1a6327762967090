"""Trial conversion per month of trial start."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.dates import (as_of_month, lit_date, month_start,
                                        stepped_month_starts)


def trial_facts(subscriptions: DataFrame) -> DataFrame:
    """One row per subscription not in status 'trialing' (a NULL status is excluded).

    ``is_converted`` compares the *raw timestamps* (trial end before cancel, or no
    cancel); the date-cast columns of the same name are outputs only.
    """
    return subscriptions.where(F.col("status") != "trialing").select(
        F.col("id").alias("subscription_id"),
        F.to_date("created_at").alias("created_at"),
        F.to_date("cancel_at").alias("cancel_at"),
        F.to_date("trial_started_at").alias("trial_started_at"),
        F.to_date("trial_end_at").alias("trial_end_at"),
        "is_cancel_at_period_end",
        ((F.col("trial_end_at") < F.col("cancel_at")) | F.col("cancel_at").isNull())
        .alias("is_converted"),
        "status",
    )


def trial_date_bounds(subscriptions: DataFrame) -> DataFrame:
    """Latest cancel date and earliest creation date (one row)."""
    return trial_facts(subscriptions).agg(F.max("cancel_at").alias("max_cancel_at"),
                                          F.min("created_at").alias("min_created_at"))


def trial_calendar(subscriptions: DataFrame) -> DataFrame:
    """Months from the earliest creation to the latest cancel plus one month.

    The series starts on the earliest creation *day* and steps one month at a
    time from the running value (so the day only ever shrinks at short months);
    the stop month is included only when that running day is not past the stop's
    day. Empty when nobody ever cancelled. One row in, one row per month out.
    """
    b = trial_date_bounds(subscriptions)
    months = stepped_month_starts(F.col("min_created_at"), F.add_months("max_cancel_at", 1))
    return b.select(F.explode(months).alias("dt"))


def trial_month_counts(subscriptions: DataFrame) -> DataFrame:
    """Per month of trial start: distinct subscriptions converted / not converted;
    calendar months without trials count 0, trials outside it keep their month.

    Trials are reduced to distinct (month, subscription, converted) first, so the
    two distinct counts become plain conditional counts, and only one row per
    month meets the calendar in the (tiny) full outer join.
    """
    known = F.col("subscription_id").isNotNull()
    per_month = (trial_facts(subscriptions)
                 .select(month_start("trial_started_at").alias("_m"), "subscription_id",
                         "is_converted")
                 .distinct()
                 .groupBy("_m")
                 .agg(F.count_if(~F.col("is_converted") & known).alias("_not"),
                      F.count_if(F.col("is_converted") & known).alias("_conv")))
    cal = trial_calendar(subscriptions)
    j = cal.join(per_month, cal.dt == per_month._m, "full")
    return j.select(
        F.coalesce("dt", "_m").alias("month_started_trial"),
        F.coalesce("_not", F.lit(0)).alias("num_not_converted_post_trial"),
        F.coalesce("_conv", F.lit(0)).alias("num_converted_post_trial"),
    )


def monthly_trialers(subscriptions: DataFrame, as_of: dt.date) -> DataFrame:
    """Monthly trial conversion with rate (a month with no trials has rate 0/1)."""
    c = trial_month_counts(subscriptions)
    conv, notc = F.col("num_converted_post_trial"), F.col("num_not_converted_post_trial")
    den = F.when(conv + notc == 0, F.lit(1)).otherwise(conv + notc)
    return (c.where(F.col("month_started_trial") <= lit_date(as_of_month(as_of)))
            .select("month_started_trial", "num_not_converted_post_trial",
                    "num_converted_post_trial",
                    (conv.cast("double") / den).alias("trial_conversion_rate")))
