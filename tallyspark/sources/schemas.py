"""Input schemas of the raw billing tables (money is integer cents)."""

from __future__ import annotations

from pyspark.sql import types as T

S, TS, B, L = T.StringType(), T.TimestampType(), T.BooleanType(), T.LongType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CUSTOMER = _struct(
    ("id", S), ("name", S), ("description", S), ("email", S), ("created", TS),
    ("address_country", S), ("address_state", S), ("address_city", S),
    ("address_postal_code", S), ("shipping_address_country", S),
    ("shipping_address_state", S), ("shipping_address_city", S),
    ("shipping_address_postal_code", S), ("delinquent", B), ("invoice_prefix", S),
    ("balance", L), ("default_card_id", S), ("livemode", B), ("is_deleted", B),
)

CARD = _struct(("id", S), ("country", S))

PRODUCT = _struct(("id", S), ("name", S))

PRODUCT_CONFIG = _struct(("product_id", S), ("name", S), ("is_main_product", B))

PRICE = _struct(
    ("id", S), ("created", TS), ("active", B), ("nickname", S), ("type", S),
    ("billing_scheme", S), ("recurring_interval", S), ("recurring_interval_count", L),
    ("tiers_mode", S), ("unit_amount", L), ("product_id", S), ("livemode", B),
    ("is_deleted", B),
)

TIER = _struct(("id", S), ("index", L), ("up_to", L), ("flat_amount", L), ("unit_amount", L))

SUBSCRIPTION_ITEM = _struct(
    ("id", S), ("created", TS), ("quantity", L), ("subscription_id", S), ("plan_id", S),
)

SUBSCRIPTION_HISTORY = _struct(
    ("id", S), ("created", TS), ("billing_cycle_anchor", TS), ("cancel_at", TS),
    ("canceled_at", TS), ("current_period_start", TS), ("current_period_end", TS),
    ("trial_start", TS), ("trial_end", TS), ("cancel_at_period_end", B), ("status", S),
    ("collection_method", S), ("customer_id", S), ("livemode", B), ("_fivetran_active", B),
)

INVOICE = _struct(
    ("id", S), ("number", S), ("created", TS), ("period_start", TS), ("period_end", TS),
    ("due_date", TS), ("paid", B), ("auto_advance", B), ("attempted", B), ("status", S),
    ("collection_method", S), ("total", L), ("amount_due", L), ("amount_paid", L),
    ("amount_remaining", L), ("attempt_count", L), ("description", S), ("footer", S),
    ("customer_id", S), ("subscription_id", S), ("charge_id", S), ("livemode", B),
    ("is_deleted", B),
)

# table name -> schema, in model-graph order
BILLING_SCHEMAS: dict[str, T.StructType] = {
    "customer": CUSTOMER,
    "card": CARD,
    "product": PRODUCT,
    "product_config": PRODUCT_CONFIG,
    "price": PRICE,
    "tier": TIER,
    "subscription_item": SUBSCRIPTION_ITEM,
    "subscription_history": SUBSCRIPTION_HISTORY,
    "invoice": INVOICE,
}
