from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tallyspark.session import get_session  # noqa: E402
from tallyspark.sources.readers import BillingTables  # noqa: E402
from tallyspark.sources.schemas import BILLING_SCHEMAS  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return get_session("local[4]", 4, app_name="tallyspark-tests")


def ts(y, m, d):
    return dt.datetime(y, m, d)


def table(spark, name, rows):
    """A billing table from a list of dicts; missing columns are NULL."""
    schema = BILLING_SCHEMAS[name]
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema=schema)


def billing(spark, **rows) -> BillingTables:
    """BillingTables with the given rows per table (others empty)."""
    return BillingTables(**{n: table(spark, n, rows.get(n, [])) for n in BILLING_SCHEMAS})


def collect_sorted(df, *keys):
    rows = [r.asDict() for r in df.collect()]
    if keys:
        def key(r):
            return tuple((r[k] is None, r[k]) for k in keys)
        rows.sort(key=key)
    return rows
