"""Money representation.

Inputs are integer cents. The reference divides into float currency units early
and then sums floats, which makes totals depend on row order. Here every sum is
done on exact integers and converted to double units only in model outputs:

* prices, tiers, invoices, ARR: **cents** (``bigint``)
* recognised revenue: **twelfths of a cent** (``bigint``): a monthly invoice of
  ``c`` cents is ``12*c``, one instalment of an annual invoice of ``c`` cents is
  ``c``; so monthly revenue ``x`` units is ``x*1200`` and ARR (= 12 × monthly
  revenue) in cents is that same integer.

Doubles produced by ``cents/100`` or ``twelfths/1200`` round-trip exactly back to
the integer with :func:`to_cents` / :func:`to_twelfths`, so models can read each
other's public (double) outputs without losing exactness.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTS_PER_UNIT = 100
TWELFTHS_PER_UNIT = 1200


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents_to_units(c: Column | str) -> Column:
    return _c(c).cast("double") / CENTS_PER_UNIT


def twelfths_to_units(c: Column | str) -> Column:
    return _c(c).cast("double") / TWELFTHS_PER_UNIT


def to_cents(units: Column | str) -> Column:
    """Exact integer cents of a double produced by :func:`cents_to_units`."""
    return F.round(_c(units) * CENTS_PER_UNIT).cast("bigint")


def to_twelfths(units: Column | str) -> Column:
    """Exact twelfths of a cent of a double produced by :func:`twelfths_to_units`."""
    return F.round(_c(units) * TWELFTHS_PER_UNIT).cast("bigint")


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, NULL when ``den`` is 0 or NULL.

    The reference leaves these divisions unguarded (an error in its database);
    a NULL keeps one bad quarter from failing the whole job. ``+ 0.0`` turns a
    negative zero into zero.
    """
    return F.try_divide(num.cast("double"), den.cast("double")) + F.lit(0.0)
