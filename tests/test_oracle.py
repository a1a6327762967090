"""Spark models vs the independent DuckDB oracle on the smallest test data."""

from __future__ import annotations

import collections
import os

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as se

# every key of queries(): the driver's correctness gate, on the smallest data
KEYS = list(se.model_queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "part", "orders"]:
        con.execute(f"create view {t} as select * from "
                    f"read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return con


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(
        tuple((r[i] + 0.0) if isinstance(r[i], float) else r[i] for i in order) for r in rows)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    df = se.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(se.oracle_sql()[key])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(rows) == len(o_rows)
    assert _bag(df.columns, rows) == _bag(o_cols, o_rows)


def test_every_query_has_an_oracle():
    assert set(se.model_queries()) <= set(se.oracle_sql())


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["month", "beginning_arr", "new_arr", "expansion_arr",
                          "contraction_arr", "churn_arr", "ending_arr"]
    assert df.count() > 0
