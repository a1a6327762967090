"""


Every query derives the billing tables from the driver's test tables
all of them with ``as_of = 2001-06-15``, and returns the DataFrame.
"""

from __future__ import annotations

import os
import sys
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle.models_sql import oracle_queries  # noqa: E402
from tallyspark.operators import (exports, monthly, quarterly, revenue,  # noqa: E402
                                  staging, trials)
from tallyspark.plans import SHARED_MODELS, ModelSet, sinks  # noqa: E402
from tallyspark.session import AS_OF_TEST, checkpoint_dir, ensure_session_conf  # noqa: E402
from tallyspark.sources import derive_billing_tables, read_billing_tables  # noqa: E402
from tallyspark.sources.readers import input_states  # noqa: E402

# The training-data operators are an optional part: without their folder, or without
# corpus_pipeline.py, everything else works.
try:
    import corpus_pipeline
    from tallyspark.llm import queries as llm_queries
except ImportError as e:
    if e.name not in ("corpus_pipeline", "tallyspark.llm"):
        raise
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF = AS_OF_TEST

Query = Callable[[SparkSession, str], DataFrame]


# One model set per (application, data folder): the derived billing tables are stored once
# as Parquet and read back by the library's reader; models read by several others are
# written once to the shared checkpoint folder. Both are made anew when the files of the
# test tables change.
# A set entered with the state None stands for itself (tests enter tables of their own).
_MODEL_SETS: dict[tuple[str, str], tuple[str | None, ModelSet]] = {}
_LOCK = threading.Lock()
_INPUTS = ("region", "nation", "customer", "part", "orders")


def _state(spark: SparkSession, sf_dir: str) -> str:
    return str(sorted(input_states(
        {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _INPUTS}).items()))


def _models(spark: SparkSession, sf_dir: str) -> ModelSet:
    ensure_session_conf(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        if key in _MODEL_SETS and _MODEL_SETS[key][0] is None:
            return _MODEL_SETS[key][1]
        state = _state(spark, sf_dir)
        if key in _MODEL_SETS and _MODEL_SETS[key][0] != state:
            _MODEL_SETS.pop(key)[1].close()
        if key not in _MODEL_SETS:
            folder = _scratch(spark, "billing")
            for name, df in derive_billing_tables(spark, sf_dir).as_dict().items():
                df.write.parquet(f"{folder}/{name}")
            _MODEL_SETS[key] = (state, ModelSet(read_billing_tables(spark, folder), AS_OF,
                                                materialize=SHARED_MODELS))
        return _MODEL_SETS[key][1]


def _model(name: str) -> Query:
    return lambda spark, sf_dir: _models(spark, sf_dir).model(name)


def _src(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(_models(spark, sf_dir).tables, name)
    return q


def _on_tables(fn: Callable) -> Query:
    """An operator over the raw billing tables."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_models(spark, sf_dir).tables)
    return q


def _on_model(model: str, fn: Callable, with_as_of: bool = False) -> Query:
    """An operator over one model's output."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _models(spark, sf_dir).model(model)
        return fn(df, AS_OF) if with_as_of else fn(df)
    return q


def _on_models(models: tuple[str, ...], fn: Callable) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        ms = _models(spark, sf_dir)
        return fn(*[ms.model(m) for m in models])
    return q


def _rev(fn: Callable) -> Query:
    """A revenue-recognition step over live invoices and subscriptions."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        ms = _models(spark, sf_dir)
        return fn(ms.tables.invoice, ms.model("stg_subscription"), AS_OF)
    return q


def _items(fn: Callable) -> Query:
    return _on_tables(lambda t: fn(t.subscription_item, t.price, t.product, t.product_config,
                                   t.tier))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/sinks-{uuid.uuid4().hex}/{name}"


def _sink_model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = _models(spark, sf_dir)
    return sinks.write_model_table(ms.model("monthly_arr"), _scratch(spark, "monthly_arr"))


def _sink_model_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persisted, then released: the result is read from the stored model."""
    held = sinks.cache_model(_models(spark, sf_dir).model("revenue"))
    return sinks.cache_model(held, no_cache=True)


def _sink_csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = _models(spark, sf_dir)
    return sinks.export_csv(ms.model("exported_quarterly_metrics"),
                            _scratch(spark, "exported_quarterly_metrics"), single_file=True)


def _read_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    # revenue is materialised into the shared folder; read it as a table
    ms = _models(spark, sf_dir)
    ms.model("revenue")
    return sinks.read_model_table(spark, ms.table_path("revenue"))


def _build_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _models(spark, sf_dir).build_until("quarterly_arr")


#: Divisions, comments, a name in capitals, and a definition that hides a model's name.
ADHOC_SQL = """
with /* revenue/100 of stg_tier/100 */ revenue as (
  select month, ending_arr, ending_arr/12 as monthly from MONTHLY_ARR where ending_arr/100 > 0)
select month, ending_arr, round(monthly/100, 2) as monthly_hundreds -- stg_price
from revenue where month not in (select month from monthly_arr where ending_arr/100 < 0)
"""


def _adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _models(spark, sf_dir).adhoc_sql(ADHOC_SQL)


def entry(spark: SparkSession) -> DataFrame:
    return _models(spark, SMOKE_DIR).model("monthly_arr")


def queries() -> dict[str, Query]:
    """Every registered query: the billing models and, if present, the training-data ones."""
    q = model_queries()
    if llm_queries is not None:
        q |= llm_queries.queries()
        q["pipeline"] = corpus_pipeline.run
    return q


def model_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    # 2.1 sources
    for t in ["customer", "card", "product", "price", "tier", "subscription_item",
              "subscription_history", "invoice", "product_config"]:
        q[f"src_{t}"] = _src(t)
    q["read_model"] = _read_model
    # 2.2 sinks
    q["sink_model_table"] = _sink_model_table
    q["sink_model_cache"] = _sink_model_cache
    q["sink_csv_export"] = _sink_csv_export
    q["build_until"] = _build_until
    q["adhoc_sql"] = _adhoc_sql
    # 2.3 staging
    q["stg_customer"] = _model("stg_customer")
    q["stg_price"] = _model("stg_price")
    q["map_product_config"] = _on_model(
        "stg_price", lambda df: df.select("id", "product_name", "is_main_product", "product_id"))
    q["label_billing_cycle"] = _on_model(
        "stg_price", lambda df: df.select("id", "recurring_interval",
                                          "recurring_interval_count", "billing_cycle"))
    q["stg_tier"] = _model("stg_tier")
    q["item_price_tiers"] = _items(staging.item_price_tiers)
    q["tiered_price_amount"] = _items(staging.tiered_price_amount)
    q["item_amount"] = _items(staging.item_amount)
    q["stg_subscription_item"] = _model("stg_subscription_item")
    q["plan_amount"] = _on_model("stg_subscription_item", staging.plan_amount)
    q["main_plan"] = _on_model("stg_subscription_item", staging.main_plan)
    q["stg_subscription"] = _model("stg_subscription")
    q["annual_value"] = _on_model(
        "stg_subscription", lambda df: df.select(
            "id", "plan_recurring_interval", "plan_recurring_interval_count", "plan_amount",
            "annual_value"))
    q["stg_invoice"] = _model("stg_invoice")
    # 2.4 revenue
    q["monthly_invoices"] = _rev(revenue.monthly_invoices)
    q["auto_renewal_flag"] = _on_model(
        "stg_subscription", lambda df: df.select(
            "id", "cancel_at", "is_cancel_at_period_end",
            revenue.auto_renewal_flag(F.col("cancel_at"), F.col("is_cancel_at_period_end"))
            .alias("is_auto_renewal")))
    q["expected_invoices"] = _rev(revenue.expected_invoices)
    q["annual_invoices"] = _rev(revenue.annual_invoices)
    q["annual_spread"] = _rev(revenue.annual_spread)
    q["monthly_revenue_union"] = _rev(revenue.monthly_revenue_union)
    q["consolidated_revenue"] = _rev(revenue.consolidated_revenue)
    q["revenue"] = _model("revenue")
    # 2.5 monthly
    q["customer_span"] = _on_model("customer_months", monthly.customer_span)
    q["customer_month_spine"] = _on_model("customer_months", monthly.customer_month_spine)
    q["customer_month_totals"] = _on_model("customer_months", monthly.customer_month_totals)
    q["customer_month_lag_lead"] = _on_model("customer_months", monthly.customer_month_lag_lead)
    q["arr_movements"] = _on_model("customer_months", monthly.arr_movements, True)
    q["arr_monthly_rollup"] = _on_model("customer_months", monthly.arr_monthly_rollup, True)
    q["monthly_arr"] = _model("monthly_arr")
    q["customer_status"] = _on_model("customer_months", monthly.customer_status, True)
    q["customer_monthly_rollup"] = _on_model("customer_months", monthly.customer_monthly_rollup, True)
    q["monthly_customers"] = _model("monthly_customers")
    q["trial_facts"] = _on_model("stg_subscription", trials.trial_facts)
    q["trial_date_bounds"] = _on_model("stg_subscription", trials.trial_date_bounds)
    q["trial_calendar"] = _on_model("stg_subscription", trials.trial_calendar)
    q["trial_month_counts"] = _on_model("stg_subscription", trials.trial_month_counts)
    q["monthly_trialers"] = _model("monthly_trialers")
    # 2.6 quarterly
    q["quarter_label"] = _on_model(
        "monthly_arr", lambda df: quarterly.with_quarter(df).select("month", "quarter_name",
                                                                    "quarter"))
    q["quarter_end_arr"] = _on_model("monthly_arr", quarterly.quarter_end_arr)
    q["quarter_begin_arr"] = _on_model("monthly_arr", quarterly.quarter_begin_arr)
    q["quarter_arr_changes"] = _on_model("monthly_arr", quarterly.quarter_arr_changes)
    q["quarter_arr_joined"] = _on_model("monthly_arr", quarterly.quarter_arr_joined)
    q["quarterly_arr"] = _model("quarterly_arr")
    q["quarter_end_customers"] = _on_model("monthly_customers", quarterly.quarter_end_customers)
    q["quarter_begin_customers"] = _on_model("monthly_customers",
                                             quarterly.quarter_begin_customers)
    q["quarter_customer_changes"] = _on_model("monthly_customers",
                                              quarterly.quarter_customer_changes)
    q["quarter_customers_joined"] = _on_model("monthly_customers",
                                              quarterly.quarter_customers_joined)
    q["quarterly_customers"] = _model("quarterly_customers")
    q["quarter_trial_sums"] = _on_model("monthly_trialers", quarterly.quarter_trial_sums)
    q["quarter_trial_rates"] = _on_model("monthly_trialers", quarterly.quarter_trial_rates, True)
    q["quarterly_trialers"] = _model("quarterly_trialers")
    # 2.7 exports
    q["arr_metrics_long"] = _on_model("quarterly_arr", exports.arr_metrics_long)
    q["customer_metrics_long"] = _on_model("quarterly_customers", exports.customer_metrics_long)
    q["acv_by_quarter"] = _on_models(("quarterly_customers", "quarterly_arr"),
                                     exports.acv_by_quarter)
    q["trialer_metrics_long"] = _on_model("quarterly_trialers", exports.trialer_metrics_long)
    q["exported_quarterly_metrics"] = _model("exported_quarterly_metrics")
    q["latest_quarter_tag"] = _on_model("quarterly_arr", exports.latest_quarter_tag)
    q["acv_growth"] = _on_models(("quarterly_customers", "quarterly_arr"), exports.acv_growth)
    q["latest_arr_metrics"] = _on_model("quarterly_arr", exports.latest_arr_metrics)
    q["latest_customer_metrics"] = _on_model("quarterly_customers",
                                             exports.latest_customer_metrics)
    q["latest_trial_metrics"] = _on_model("quarterly_trialers", exports.latest_trial_metrics)
    q["latest_acv_metrics"] = _on_models(("quarterly_customers", "quarterly_arr"),
                                         exports.latest_acv_metrics)
    q["exported_latest_metrics"] = _model("exported_latest_metrics")
    return q


# keys whose result is another model's rows (sinks, reads, partial builds)
_SAME_AS = {
    "read_model": "revenue",
    "sink_model_table": "monthly_arr",
    "sink_model_cache": "revenue",
    "sink_csv_export": "exported_quarterly_metrics",
    "build_until": "quarterly_arr",
}


def oracle_sql() -> dict[str, str]:
    """For each key in ``queries()``, equivalent SQL runnable by DuckDB on the
    driver's parquet tables (see ``oracle/``)."""
    o = oracle_queries()
    for key, model in _SAME_AS.items():
        o[key] = o[model]
    from oracle.models_sql import compose
    o["adhoc_sql"] = compose(f"select * from ({ADHOC_SQL.lower()})")
    o = {k: o[k] for k in model_queries() if k in o}
    if llm_queries is not None:
        o |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            o["pipeline"] = corpus_pipeline.ORACLE_SQL
    return o
