"""Output contracts of the models: column names and order, metric labels."""

from __future__ import annotations

from conftest import SF_SMALL

from tallyspark.operators import exports, monthly, quarterly, revenue, staging
from tallyspark.plans import SHARED_MODELS, ModelSet
from tallyspark.session import AS_OF_TEST
from tallyspark.sources import derive_billing_tables


def test_model_columns_and_labels(spark):
    ms = ModelSet(derive_billing_tables(spark, SF_SMALL), AS_OF_TEST, materialize=SHARED_MODELS)
    assert ms.model("stg_price").columns == staging.STG_PRICE_COLUMNS
    assert ms.model("stg_subscription_item").columns == staging.STG_ITEM_COLUMNS
    assert ms.model("stg_subscription").columns == staging.STG_SUBSCRIPTION_COLUMNS
    assert ms.model("monthly_arr").columns == monthly.MONTHLY_ARR_COLUMNS
    assert ms.model("quarterly_arr").columns == quarterly.QUARTERLY_ARR_COLUMNS
    assert ms.model("exported_quarterly_metrics").columns == exports.LONG_COLUMNS
    assert ms.model("revenue").columns[:3] == ["id", "customer_name", "recognized_at"]
    union = revenue.monthly_revenue_union(ms.tables.invoice, ms.model("stg_subscription"),
                                          AS_OF_TEST)
    assert union.columns == revenue.BRANCH_COLUMNS
    latest = [r.metric for r in ms.model("exported_latest_metrics").collect()]
    assert sorted(latest) == sorted(exports.LATEST_METRICS)
    labels = {r.metric for r in ms.model("exported_quarterly_metrics")
              .select("metric").distinct().collect()}
    expected = ({m for m, _ in exports.ARR_METRICS} | {m for m, _ in exports.CUSTOMER_METRICS}
                | {exports.ACV_METRIC} | {m for m, _ in exports.TRIALER_METRICS})
    assert labels == expected and len(expected) == 19
