"""Date helpers: month/quarter starts, quarter labels, month series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c: ColumnOrName) -> Column:
    """First day of the month, as a DATE (``date_trunc('month', x)::date``)."""
    return F.trunc(_c(c), "MM")


def quarter_start(c: ColumnOrName) -> Column:
    """First day of the quarter, as a DATE."""
    return F.trunc(_c(c), "quarter")


def quarter_label(c: ColumnOrName) -> Column:
    """'Qn YYYY' for the quarter holding date ``c``."""
    d = _c(c)
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit(" "),
                    F.year(d).cast("string"))


def month_series(start: ColumnOrName, stop: ColumnOrName) -> Column:
    """Array of month starts from ``start`` to ``stop`` inclusive (both month starts).

    NULL when either bound is NULL; empty when ``stop`` is before ``start``
    (``sequence`` itself would raise on a backwards range).
    """
    s, e = _c(start), _c(stop)
    return F.when(e >= s, F.sequence(s, e, F.expr("interval 1 month"))) \
            .otherwise(F.when(s.isNotNull() & e.isNotNull(), F.array().cast("array<date>")))


def lit_date(d: dt.date) -> Column:
    return F.lit(d).cast("date")


def lit_ts(d: dt.date) -> Column:
    """Midnight (session time zone, UTC) of ``d`` as a TIMESTAMP literal."""
    return F.lit(dt.datetime(d.year, d.month, d.day)).cast("timestamp")


def as_of_month(as_of: dt.date) -> dt.date:
    return as_of.replace(day=1)


def add_months(d: dt.date, n: int) -> dt.date:
    """Month arithmetic on month starts (driver-side, for literal bounds only)."""
    y, m = divmod(d.year * 12 + (d.month - 1) + n, 12)
    return dt.date(y, m + 1, 1)


def as_of_quarter(as_of: dt.date) -> dt.date:
    return dt.date(as_of.year, 3 * ((as_of.month - 1) // 3) + 1, 1)


def stepped_month_starts(start: ColumnOrName, stop: ColumnOrName) -> Column:
    """Months visited by a series that starts on ``start`` (a date) and adds one
    month at a time to its *running* value while it is not past ``stop``.

    Adding to the running value clamps the day at every short month (Jan 31 ->
    Feb 29 -> Mar 29), so every month from ``start``'s to ``stop``'s is visited
    except possibly the last one: it is visited only when the running day, the
    smallest month length met on the way (and ``start``'s own day), is not past
    ``stop``'s day. Returned as an array of month starts; empty when ``stop`` is
    before ``start``; NULL when either is NULL.
    """
    b, e = _c(start), _c(stop)
    first_m, stop_m = month_start(b), month_start(e)
    months = month_series(first_m, stop_m)
    later = month_series(F.add_months(first_m, 1), stop_m)
    run_day = F.aggregate(later, F.dayofmonth(b),
                          lambda acc, m: F.least(acc, F.dayofmonth(F.last_day(m))))
    drop_last = (F.size(months) > 0) & (run_day > F.dayofmonth(e))
    return F.when(drop_last, F.slice(months, 1, F.size(months) - 1)).otherwise(months)
