"""Join helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def spread_null_key(key: Column, *row: Column) -> Column:
    """Shuffle key for the preserved side of a left outer join on a nullable foreign key.

    A NULL key never matches, but left as NULL every such row hashes to the same
    shuffle partition: one task would receive all of them (say, a third of all
    invoices without a customer). Each NULL becomes the full hash of the row's own
    columns ``row``, so those rows spread over the whole shuffle. Join with
    :func:`matches`, which also asks that the key itself is known: a real key that
    happens to read like a hash therefore matches nothing.
    """
    return F.coalesce(key.cast("string"), F.xxhash64(*row).cast("string"))


def matches(key: Column, other: Column, *row: Column) -> Column:
    """Left-join condition ``key = other`` with the NULL keys spread over the shuffle."""
    return (spread_null_key(key, *row) == other) & key.isNotNull()
