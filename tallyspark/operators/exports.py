"""Long-format metric exports: per quarter, and the latest quarter's values.

Inputs are the three quarterly models (one row per quarter). Each wide model is
turned into ``(quarter, quarter_name, metric, value)`` rows with one ``unpivot``
instead of one scan per metric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Metric labels of the exports (must equal the reference's labels
# exactly; note the trailing space in "Trialer % Quarterly growth ").
ARR_METRICS = [
    ("Beginning ARR", "beginning_arr"),
    ("New ARR", "new_arr"),
    ("Expansion ARR", "expansion_arr"),
    ("Contraction ARR", "contraction_arr"),
    ("Churn ARR", "churn_arr"),
    ("Ending ARR", "ending_arr"),
    ("ARR % YoY growth", "yearly_growth_rate"),
    ("ARR % Quarterly growth", "quarterly_growth_rate"),
    ("ARR Quarterly Expansion Rate", "expansion_rate"),
]
CUSTOMER_METRICS = [
    ("Beginning customers", "beginning_customers"),
    ("New customers", "new_customers"),
    ("Churn customers", "churn_customers"),
    ("Ending customers", "ending_customers"),
    ("Customers % YoY growth", "yearly_growth_rate"),
    ("Customers % Quarterly growth", "quarterly_growth_rate"),
    ("Avg Monthly Customer Churn Rate", "avg_monthly_churn"),
]
ACV_METRIC = "Annual Contract Value"
TRIALER_METRICS = [
    ("Trial Quarterly Conversion Rate", "trial_conversion_rate"),
    ("Trialer % Quarterly growth ", "quarterly_growth_rate"),
]
# rate metrics exported only where they are not NULL
NON_NULL_ONLY = [
    "ARR % YoY growth", "ARR % Quarterly growth", "ARR Quarterly Expansion Rate",
    "Customers % YoY growth", "Customers % Quarterly growth", "Avg Monthly Customer Churn Rate",
]
LATEST_METRICS = [
    "Latest Year", "Latest Quarter",
    "Latest Ending ARR", "Latest Expansion ARR", "Latest Expansion Rate",
    "Latest Contraction Rate",
    "Latest Monthly Average Churn Rate", "Latest Ending # Customers",
    "Latest Trial Conversion Rate", "Latest Trialer Quarterly Growth Rate", "Latest # Trialers",
    "Latest Annual Contract Value", "Latest Annual Contract Value % Growth Rate",
]

LONG_COLUMNS = ["quarter", "quarter_name", "metric", "value"]


def _long(df: DataFrame, metrics: list[tuple[str, str]]) -> DataFrame:
    """Unpivot ``metrics`` (label, column) of a per-quarter model to long rows."""
    wide = df.select("quarter", "quarter_name",
                     *[F.col(c).cast("double").alias(label) for label, c in metrics])
    long = wide.unpivot(["quarter", "quarter_name"], [label for label, _ in metrics],
                        "metric", "value")
    return long.where(~F.col("metric").isin(*NON_NULL_ONLY) | F.col("value").isNotNull())


def arr_metrics_long(quarterly_arr: DataFrame) -> DataFrame:
    return _long(quarterly_arr, ARR_METRICS)


def customer_metrics_long(quarterly_customers: DataFrame) -> DataFrame:
    return _long(quarterly_customers, CUSTOMER_METRICS)


def _acv(ending_arr: Column, ending_customers: Column) -> Column:
    """Ending ARR ÷ ending customers; NULL when there are no customers."""
    return F.try_divide(ending_arr.cast("double"), ending_customers.cast("double")) + F.lit(0.0)


def acv_by_quarter(quarterly_customers: DataFrame, quarterly_arr: DataFrame) -> DataFrame:
    """Annual contract value per quarter of the customer model (ARR may be missing)."""
    j = quarterly_customers.select("quarter", "quarter_name", "ending_customers").join(
        quarterly_arr.select("quarter", "quarter_name", "ending_arr"),
        ["quarter", "quarter_name"], "left")
    return j.select("quarter", "quarter_name", F.lit(ACV_METRIC).alias("metric"),
                    _acv(F.col("ending_arr"), F.col("ending_customers")).alias("value"))


def trialer_metrics_long(quarterly_trialers: DataFrame) -> DataFrame:
    return _long(quarterly_trialers, TRIALER_METRICS)


def exported_quarterly_metrics(quarterly_arr: DataFrame, quarterly_customers: DataFrame,
                               quarterly_trialers: DataFrame) -> DataFrame:
    """All per-quarter metrics (19 labels), newest quarter first."""
    return (arr_metrics_long(quarterly_arr)
            .unionByName(customer_metrics_long(quarterly_customers))
            .unionByName(acv_by_quarter(quarterly_customers, quarterly_arr))
            .unionByName(trialer_metrics_long(quarterly_trialers))
            .orderBy(F.col("quarter").desc_nulls_first()))


# ------------------------------------------------------------------ latest quarter

def latest_quarter_tag(df: DataFrame) -> DataFrame:
    """Add the model's own latest quarter, the quarter number (2nd character of the
    label) and the year. The global window sees one row per quarter."""
    return df.withColumns({
        "latest_quarter": F.max("quarter").over(Window.partitionBy()),
        "quarter_number": F.substring("quarter_name", 2, 1).cast("int"),
        "year": F.year("quarter"),
    })


def _metric_rows(df: DataFrame, metrics: list[tuple[str, str]]) -> DataFrame:
    """(metric, value) rows of the latest quarter of a tagged model."""
    latest = df.where(F.col("quarter") == F.col("latest_quarter"))
    return (latest.select(*[F.col(c).cast("double").alias(label) for label, c in metrics])
            .unpivot([], [label for label, _ in metrics], "metric", "value"))


def acv_growth(quarterly_customers: DataFrame, quarterly_arr: DataFrame) -> DataFrame:
    """Quarter-on-quarter change of ending ARR ÷ ending customers, over the customer
    model's quarters (ARR's latest quarter attached)."""
    arr = latest_quarter_tag(quarterly_arr).select("quarter", "latest_quarter", "ending_arr")
    j = quarterly_customers.select("quarter", "ending_customers").join(arr, ["quarter"], "left")
    w = Window.orderBy(F.col("quarter").asc_nulls_last())
    cur = F.try_divide(F.col("ending_arr").cast("double"), F.col("ending_customers").cast("double"))
    prev = F.try_divide(F.lag("ending_arr").over(w).cast("double"),
                        F.lag("ending_customers").over(w).cast("double"))
    return j.select("quarter", "latest_quarter",
                    F.lit("Latest Annual Contract Value % Growth Rate").alias("metric"),
                    (F.try_divide(cur - prev, prev) + F.lit(0.0)).alias("value"))


def latest_arr_metrics(quarterly_arr: DataFrame) -> DataFrame:
    return _metric_rows(latest_quarter_tag(quarterly_arr), [
        ("Latest Ending ARR", "ending_arr"),
        ("Latest Expansion ARR", "expansion_arr"),
        ("Latest Expansion Rate", "expansion_rate"),
        ("Latest Contraction Rate", "contraction_rate"),
    ])


def latest_customer_metrics(quarterly_customers: DataFrame) -> DataFrame:
    return _metric_rows(latest_quarter_tag(quarterly_customers), [
        ("Latest Monthly Average Churn Rate", "avg_monthly_churn"),
        ("Latest Ending # Customers", "ending_customers"),
    ])


def latest_trial_metrics(quarterly_trialers: DataFrame) -> DataFrame:
    return _metric_rows(latest_quarter_tag(quarterly_trialers), [
        ("Latest Trial Conversion Rate", "trial_conversion_rate"),
        ("Latest Trialer Quarterly Growth Rate", "quarterly_growth_rate"),
        ("Latest # Trialers", "num_trialers"),
    ])


def latest_acv_metrics(quarterly_customers: DataFrame, quarterly_arr: DataFrame) -> DataFrame:
    """ACV of the latest quarter (only when both models' latest quarters coincide)
    and its growth rate."""
    keys = ["quarter", "quarter_name", "quarter_number", "year"]
    cust = latest_quarter_tag(quarterly_customers)
    arr = latest_quarter_tag(quarterly_arr)
    c = cust.where(F.col("quarter") == F.col("latest_quarter")).select(*keys, "ending_customers")
    a = arr.where(F.col("quarter") == F.col("latest_quarter")).select(*keys, "ending_arr")
    acv = c.join(a, keys, "inner").select(
        F.lit("Latest Annual Contract Value").alias("metric"),
        _acv(F.col("ending_arr"), F.col("ending_customers")).alias("value"))
    growth = (acv_growth(quarterly_customers, quarterly_arr)
              .where(F.col("latest_quarter") == F.col("quarter")).select("metric", "value"))
    return acv.unionByName(growth)


def exported_latest_metrics(quarterly_arr: DataFrame, quarterly_customers: DataFrame,
                            quarterly_trialers: DataFrame) -> DataFrame:
    """Headline numbers of the latest quarter: 13 (metric, value) rows."""
    arr = latest_quarter_tag(quarterly_arr)
    head = _metric_rows(arr, [("Latest Year", "year"), ("Latest Quarter", "quarter_number")])
    return (head
            .unionByName(latest_arr_metrics(quarterly_arr))
            .unionByName(latest_customer_metrics(quarterly_customers))
            .unionByName(latest_trial_metrics(quarterly_trialers))
            .unionByName(latest_acv_metrics(quarterly_customers, quarterly_arr)))
