"""The command line: setup writes the config seed, create builds models and exports."""

from __future__ import annotations

import os
import tempfile

import pytest
from conftest import SF_SMALL

from tallyspark.plans import cli, sinks
from tallyspark.sources import derive_billing_tables


def test_setup_then_create_until_a_model(spark):
    root = tempfile.mkdtemp(prefix="cli-")
    for name, df in derive_billing_tables(spark, SF_SMALL).as_dict().items():
        if name != "product_config":
            df.write.parquet(f"{root}/billing/{name}")
    cli.main(["setup", "--billing", f"{root}/billing", "--config", f"{root}/config"])
    cfg = spark.read.option("header", True).csv(f"{root}/config")
    assert cfg.count() == spark.read.parquet(f"{root}/billing/product").count()
    cli.main(["create", "--billing", f"{root}/billing", "--out", f"{root}/out",
              "--config", f"{root}/config", "--as-of", "2001-06-15", "--model", "revenue"])
    built = sorted(set(os.listdir(f"{root}/out/models")) - {"customer_months", "priced_items"})
    assert built == sorted(["stg_customer", "stg_price", "stg_tier", "stg_subscription_item",
                            "stg_subscription", "stg_invoice", "revenue"])
    first = sinks._finished(spark, f"{root}/out/models/revenue")
    assert sinks.read_model_table(spark, f"{root}/out/models/revenue").count() > 0
    # an edited config is not overwritten
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        cli.main(["setup", "--billing", f"{root}/billing", "--config", f"{root}/config"])
    cli.main(["setup", "--billing", f"{root}/billing", "--config", f"{root}/config", "--force"])
    # --model implies force; without it the same date and config keep the tables
    again = ["create", "--billing", f"{root}/billing", "--out", f"{root}/out",
             "--config", f"{root}/config", "--as-of", "2001-06-15"]
    cli.main([*again, "--model", "stg_customer"])
    assert sinks._finished(spark, f"{root}/out/models/stg_customer")[-1]["number"] == 2
    assert sinks._finished(spark, f"{root}/out/models/revenue") == first
    cli.main(["create", "--billing", f"{root}/billing", "--out", f"{root}/out",
              "--as-of", "2001-06-15", "--no-cache"])
    assert sorted(os.listdir(f"{root}/out/exports")) == ["exported_latest_metrics",
                                                          "exported_quarterly_metrics"]
    # without a retention time only the present versions are left
    cli.main([*again, "--model", "stg_customer", "--retain-hours", "0"])
    assert len(sinks._finished(spark, f"{root}/out/models/stg_customer")) == 1
    latest = spark.read.option("header", True).csv(f"{root}/out/exports/exported_latest_metrics")
    assert latest.count() == 13
