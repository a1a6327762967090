"""The model graph: every model as a lazily built, optionally materialised DataFrame.

A model's dependencies are plain DataFrame arguments, so asking for one model
builds exactly its lineage (``build_until``). The ten models that others read
(``SHARED_MODELS``) and the customer-month table behind both monthly models can be
materialised: written as Parquet into the session's shared checkpoint folder and
read back, which computes them once and cuts the lineage, so a lost executor only
recomputes from the last written model.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from tallyspark.operators import exports, monthly, quarterly, revenue, staging, trials
from tallyspark.plans import sinks
from tallyspark.plans.names import named_tables
from tallyspark.session import checkpoint_dir
from tallyspark.sources.readers import BillingTables, input_states

# Models read by other models. Materialising them (as the reference persists its
# saved models) computes each once when the whole graph is built; leaves such as
# stg_price, stg_tier, stg_invoice and the two exports stay lazy.
SHARED_MODELS = ("stg_customer", "stg_subscription_item", "stg_subscription", "revenue",
                 "monthly_arr", "monthly_customers", "monthly_trialers", "quarterly_arr",
                 "quarterly_customers", "quarterly_trialers")

# Tables between models, stored with the model named; they have no name of their own in the
# reference.
INTERNAL = {"customer_months": "revenue", "priced_items": "stg_subscription_item"}

# Texts are analysed one at a time: meanwhile the session holds views of the models' names.
_SQL_LOCK = threading.RLock()


class ModelSet:
    """All models over one set of billing tables and one as-of date."""

    # every model, in graph order (dependencies first)
    NAMES = ("stg_customer", "stg_price", "stg_tier", "stg_subscription_item",
             "stg_subscription", "stg_invoice", "revenue", "monthly_arr", "monthly_customers",
             "monthly_trialers", "quarterly_arr", "quarterly_customers", "quarterly_trialers",
             "exported_quarterly_metrics", "exported_latest_metrics")

    def __init__(self, tables: BillingTables, as_of: dt.date,
                 materialize: Iterable[str] = (), folder: str | None = None,
                 force: bool = True, cache: bool = False,
                 retain: float = sinks.RETAIN_SECONDS):
        """``materialize``: models written to ``folder`` (default: a new folder under
        the session's checkpoint folder) and read back. A table stored there before is
        kept only if ``force`` is off and it has the same schema, as-of date, product
        config and inputs. ``cache``: persist the models that replace a stored version
        (a model stored for the first time is not persisted); without it, every version of
        them that any set has persisted is freed. ``retain``: seconds for which a replaced
        version can still be read."""
        self.tables = tables
        self.as_of = as_of
        self.spark: SparkSession = tables.invoice.sparkSession
        self._materialize = set(materialize)
        self._folder = folder
        self._force = force
        self._cache = cache
        self._retain = retain
        self._built: dict[str, DataFrame] = {}
        self._prices: DataFrame | None = None
        self._stamp: str | None = None
        self._made_folder: str | None = None
        self.persisted: set[str] = set()
        # one builder at a time: a model is materialised once even when several
        # threads ask for it (re-entrant, as building a model builds its inputs)
        self._lock = threading.RLock()
        self._defs: dict[str, Callable[[], DataFrame]] = self._definitions()
        assert tuple(n for n in self._defs if n not in INTERNAL) == self.NAMES

    # ---------------------------------------------------------------- graph
    def _definitions(self) -> dict[str, Callable[[], DataFrame]]:
        t, a, m = self.tables, self.as_of, self.model
        return {
            "stg_customer": lambda: staging.stg_customer(t.customer, t.card),
            "stg_price": lambda: self.prices.select(*staging.STG_PRICE_COLUMNS),
            "stg_tier": lambda: staging.stg_tier(t.tier),
            "priced_items": lambda: staging.priced_items(t.subscription_item, self.prices,
                                                         t.tier),
            "stg_subscription_item": lambda: staging.items_with_amounts(m("priced_items")),
            "stg_subscription": lambda: staging.stg_subscription(
                t.subscription_history, m("stg_customer"), m("stg_subscription_item")),
            "stg_invoice": lambda: staging.stg_invoice(
                t.invoice, m("stg_customer"), m("stg_subscription")),
            "revenue": lambda: revenue.revenue(t.invoice, m("stg_subscription"), a),
            "customer_months": lambda: monthly.customer_months(m("revenue")),
            "monthly_arr": lambda: monthly.monthly_arr(m("customer_months"), a),
            "monthly_customers": lambda: monthly.monthly_customers(m("customer_months"), a),
            "monthly_trialers": lambda: trials.monthly_trialers(m("stg_subscription"), a),
            "quarterly_arr": lambda: quarterly.quarterly_arr(m("monthly_arr"), a),
            "quarterly_customers": lambda: quarterly.quarterly_customers(
                m("monthly_customers"), a),
            "quarterly_trialers": lambda: quarterly.quarterly_trialers(m("monthly_trialers"), a),
            "exported_quarterly_metrics": lambda: exports.exported_quarterly_metrics(
                m("quarterly_arr"), m("quarterly_customers"), m("quarterly_trialers")),
            "exported_latest_metrics": lambda: exports.exported_latest_metrics(
                m("quarterly_arr"), m("quarterly_customers"), m("quarterly_trialers")),
        }

    @property
    def prices(self) -> DataFrame:
        """Live prices with product config applied and exact cents (built once)."""
        with self._lock:
            if self._prices is None:
                t = self.tables
                self._prices = staging.priced(t.price, t.product, t.product_config)
            return self._prices

    @property
    def names(self) -> list[str]:
        return list(self.NAMES)

    def model(self, name: str) -> DataFrame:
        """The named model's DataFrame (built once; materialised if requested)."""
        with self._lock:
            return self._model(name)

    def _model(self, name: str) -> DataFrame:
        if name not in self._built:
            if name not in self._defs:
                raise KeyError(f"unknown model {name!r}; known: {', '.join(self._defs)}")
            df = self._defs[name]()
            if name in self._materialize or INTERNAL.get(name) in self._materialize:
                path = self.table_path(name)
                df, number, new = sinks.store_model_table(
                    df, path, force=self._force, stamp=self.stamp, retain=self._retain)
                if not self._cache:
                    df = sinks.cache_model(df, no_cache=True, path=path)
                elif new and number > 1:
                    df = sinks.cache_model(df, path=path)
                    self.persisted.add(name)
            self._built[name] = df
        return self._built[name]

    @property
    def stamp(self) -> str:
        """What every stored model of this set depends on: the as-of date, the product
        config, and the input files (or, for inputs without files, their plans). Empty in a
        folder that the set chose itself: no other set will look for its tables there."""
        if self._made_folder is not None:
            return ""
        if self._stamp is None:
            tables = self.tables.as_dict()
            self._stamp = sinks.stamp_of(
                as_of=self.as_of, config=sinks.checksum(tables.pop("product_config")),
                **input_states(tables))
        return self._stamp

    def close(self) -> None:
        """Release what this set holds: persisted models, and its folder if it chose it."""
        for name in self.persisted:
            sinks.release_model(self._built[name], self.table_path(name))
        self.persisted.clear()
        if self._made_folder is not None:
            sinks.delete_folder(self.spark, self._made_folder)
            self._made_folder = self._folder = None
        self._built.clear()

    __getitem__ = model

    def build_until(self, name: str) -> DataFrame:
        """Build the graph up to one model and stop: only its lineage is planned."""
        return self.model(name)

    # ---------------------------------------------------------------- helpers
    def table_path(self, name: str) -> str:
        """Where a materialised model is stored (under the shared checkpoint folder)."""
        if self._folder is None:
            self._folder = f"{checkpoint_dir(self.spark).rstrip('/')}/models-{uuid.uuid4().hex}"
            self._made_folder = self._folder
        return f"{self._folder}/{name}"

    def register_views(self, names: Iterable[str] | None = None) -> None:
        """Expose models (default: all) to SQL as temp views of the same name."""
        for n in (self.names if names is None else names):
            self.model(n).createOrReplaceTempView(n)

    def adhoc_sql(self, text: str) -> DataFrame:
        """Run one SQL text over the models (named in any case) and the raw tables (as
        ``raw_<table>``); errors raise as usual. Only the models the text names are built: its
        names are those that Spark's own parser finds, so strings, comments and names that
        ``with`` defines count for nothing. A text that computes a name (``identifier(...)``)
        has all models to choose from. The names are views while the text is analysed; views of
        the caller that have the same names are put back afterwards, and the others dropped."""
        found, computed = named_tables(self.spark, text)
        said = {n[0].lower() for n in found if len(n) == 1}
        raw = {f"raw_{n}": df for n, df in self.tables.as_dict().items()}
        views = {n: df for n, df in raw.items() if computed or n in said}
        views |= {n: self.model(n) for n in self.names if computed or n in said}
        catalog = self.spark.catalog
        with _SQL_LOCK:
            mine = {t.name.lower() for t in catalog.listTables() if t.isTemporary}
            before = {n: self.spark.table(n) for n in views if n in mine}
            try:
                for n, df in views.items():
                    df.createOrReplaceTempView(n)
                return self.spark.sql(text)
            finally:
                for n in views:
                    if n in before:
                        before[n].createOrReplaceTempView(n)
                    else:
                        catalog.dropTempView(n)
