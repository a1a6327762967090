"""Inputs: schemas, readers, the product configuration, test-data derivation."""

from tallyspark.sources.derive import derive_billing_tables
from tallyspark.sources.readers import (BillingTables, product_config_from_mapping,
                                        read_billing_tables, seed_product_config)
from tallyspark.sources.schemas import BILLING_SCHEMAS

__all__ = ["BILLING_SCHEMAS", "BillingTables", "derive_billing_tables",
           "product_config_from_mapping", "read_billing_tables", "seed_product_config"]
