"""Pricing rules as column expressions (all amounts in integer cents)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def billing_cycle(interval: Column, count: Column) -> Column:
    """Label of a recurring interval; NULL for anything not listed."""
    return (F.when((interval == "month") & (count == 1), F.lit("monthly"))
            .when((interval == "month") & (count == 3), F.lit("quarterly"))
            .when((interval == "month") & (count == 6), F.lit("biannually"))
            .when((interval == "year") & (count == 1), F.lit("annually")))


def tier_amount(quantity: Column, up_to: Column, prev_up_to: Column,
                flat: Column, unit: Column) -> Column:
    """Amount one tier row contributes for ``quantity`` units (graduated pricing).

    * quantity above the tier's bound: the whole tier
      (its flat amount, else ``(bound - previous bound) * unit``);
    * quantity inside ``(previous bound, bound]`` (NULL bounds are open): the part in
      this tier (flat amount, else ``(quantity - previous bound) * unit``);
    * otherwise NULL (the tier is not reached).

    A flat amount replaces the per-unit part; a flat amount of 0 counts as present.
    The price's ``tiers_mode`` is deliberately not consulted (the reference does not).
    """
    prev0 = F.coalesce(prev_up_to, F.lit(0))
    above = quantity > up_to
    inside = (((quantity > prev_up_to) | prev_up_to.isNull())
              & ((quantity <= up_to) | up_to.isNull()))
    return (F.when(above, F.coalesce(flat, (up_to - prev0) * unit))
            .when(inside, F.coalesce(flat, (quantity - prev0) * unit)))


def annual_value(interval: Column, count: Column, amount: Column) -> Column:
    """Yearly value of a plan amount.

    year: ``(1 div n) * amount``; month: ``(12 div n) * amount``; else NULL.
    The division is *integer* division, as in the reference (a two-year plan is
    worth 0 a year, a 5-month plan 2 × amount). A count of 0 gives NULL.
    """
    per_year = (F.when(interval == "year", F.lit(1))
                .when(interval == "month", F.lit(12)))
    return F.try_divide(per_year, count).cast("bigint") * amount
