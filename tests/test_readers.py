"""Reading billing tables: explicit schema, CSV with a header, no silent narrowing."""

from __future__ import annotations

import os
import tempfile

import pytest
from conftest import SF_SMALL, collect_sorted

from tallyspark.sources import derive_billing_tables, read_billing_tables
from tallyspark.sources.readers import input_state, read_table
from tallyspark.sources.schemas import BILLING_SCHEMAS


def _root():
    return tempfile.mkdtemp(prefix="readers-")


def test_parquet_and_csv_give_the_same_tables(spark):
    derived = derive_billing_tables(spark, SF_SMALL).as_dict()
    root = _root()
    for name in ("price", "tier", "product", "customer"):
        # columns in another order, and one more
        df = derived[name].selectExpr(*reversed(derived[name].columns), "1 as extra")
        df.write.parquet(f"{root}/p/{name}")
        df.write.option("header", True).csv(f"{root}/c/{name}")
        a, b = read_table(spark, f"{root}/p", name), read_table(spark, f"{root}/c", name, "csv")
        assert [(f.name, f.dataType) for f in a.schema] == [
            (f.name, f.dataType) for f in BILLING_SCHEMAS[name]]
        assert collect_sorted(a, "id") == collect_sorted(b, "id") == collect_sorted(
            derived[name], "id")


@pytest.mark.parametrize("kind,value", [("double", "12.5"), ("decimal(10,2)", "12.50"),
                                        ("string", "'12.5'")])
def test_fractional_amounts_are_refused(spark, kind, value):
    root = _root()
    cols = ", ".join(f"cast({value if f.name == 'unit_amount' else 'null'} as "
                     f"{kind if f.name == 'unit_amount' else f.dataType.simpleString()}) as {f.name}"
                     for f in BILLING_SCHEMAS["price"])
    spark.sql(f"select {cols}").write.parquet(f"{root}/price")
    with pytest.raises(Exception, match="not a whole number"):
        read_table(spark, root, "price").collect()


def test_whole_amounts_of_any_type_are_read(spark):
    root = _root()
    cols = ", ".join(f"cast({'1200' if f.name == 'unit_amount' else 'null'} as "
                     f"{'double' if f.name == 'unit_amount' else f.dataType.simpleString()}) as {f.name}"
                     for f in BILLING_SCHEMAS["price"])
    spark.sql(f"select {cols}").write.parquet(f"{root}/price")
    assert read_table(spark, root, "price").first().unit_amount == 1200


def test_input_state_follows_replaced_files(spark):
    path = os.path.join(_root(), "t")
    spark.range(5).write.parquet(path)
    before = input_state(spark.read.parquet(path))
    assert before == input_state(spark.read.parquet(path))
    spark.range(6).write.mode("overwrite").parquet(path)
    assert input_state(spark.read.parquet(path)) != before
    assert input_state(spark.range(3)).startswith("plan")


def test_stored_config_is_used(spark):
    derived = derive_billing_tables(spark, SF_SMALL).as_dict()
    root = _root()
    for name, df in derived.items():
        df.write.parquet(f"{root}/{name}")
    got = read_billing_tables(spark, root).product_config
    assert collect_sorted(got, "product_id") == collect_sorted(derived["product_config"],
                                                              "product_id")
