"""Staging models: clean, rename and join the raw billing tables.

Join strategy. No join carries a hint: Spark's byte threshold and adaptive
execution pick broadcast or shuffle from real sizes, and either gives the same
rows. NULL foreign keys on the preserved side of a left join are spread over the
shuffle (:func:`matches`) instead of all landing in one task; hot keys are left to
adaptive execution's skew split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.joins import matches
from tallyspark.functions.money import cents_to_units, to_cents
from tallyspark.functions.pricing import annual_value, billing_cycle, tier_amount


def _live(df: DataFrame) -> DataFrame:
    """``livemode and not is_deleted`` (a NULL in either excludes the row)."""
    return df.where(F.col("livemode") & ~F.col("is_deleted"))


# --------------------------------------------------------------------------- customer

def stg_customer(customer: DataFrame, card: DataFrame) -> DataFrame:
    """Live customers with display name, location fallbacks and balance in units."""
    cards = card.select(F.col("id").alias("_card_id"), F.col("country").alias("_card_country"))
    src = _live(customer).join(
        cards, matches(F.col("default_card_id"), F.col("_card_id"), F.col("id")), "left")
    return src.select(
        "id",
        F.coalesce("name", "description", F.lower("email")).alias("name"),
        F.col("created").alias("created_at"),
        F.lower("email").alias("email"),
        F.coalesce("address_country", "shipping_address_country", "_card_country").alias("country"),
        F.coalesce("address_state", "shipping_address_state").alias("state"),
        F.coalesce("address_city", "shipping_address_city").alias("city"),
        F.coalesce("address_postal_code", "shipping_address_postal_code").alias("zip"),
        F.col("delinquent").alias("is_delinquent"),
        "invoice_prefix",
        cents_to_units("balance").alias("balance"),
    )


# --------------------------------------------------------------------------- price

STG_PRICE_COLUMNS = [
    "id", "product_name", "created_at", "is_active", "is_main_product", "description", "type",
    "billing_scheme", "billing_cycle", "tiers_mode", "recurring_interval",
    "recurring_interval_count", "unit_amount", "product_id",
]


def map_product_config(product_id: Column, product_name: Column,
                       cfg_id: Column, cfg_name: Column, cfg_main: Column) -> tuple[Column, Column]:
    """Name and main flag of a product: the config entry wins when one exists for the
    *joined* product id; otherwise the product's own name and ``true``."""
    has_cfg = cfg_id.isNotNull()
    return (F.when(has_cfg, cfg_name).otherwise(product_name),
            F.when(has_cfg, cfg_main).otherwise(F.lit(True)))


def priced(price: DataFrame, product: DataFrame, product_config: DataFrame) -> DataFrame:
    """``stg_price`` plus ``unit_amount_cents`` (exact) for the pricing of items."""
    prod = product.select(F.col("id").alias("_prod_id"), F.col("name").alias("_prod_name"))
    cfg = product_config.select(F.col("product_id").alias("_cfg_id"),
                                F.col("name").alias("_cfg_name"),
                                F.col("is_main_product").alias("_cfg_main"))
    src = (_live(price)
           .join(prod, matches(F.col("product_id"), F.col("_prod_id"), F.col("id")), "left")
           .join(cfg, matches(F.col("_prod_id"), F.col("_cfg_id"), F.col("id")), "left"))
    name, main = map_product_config(F.col("_prod_id"), F.col("_prod_name"), F.col("_cfg_id"),
                                    F.col("_cfg_name"), F.col("_cfg_main"))
    return src.select(
        "id",
        name.alias("product_name"),
        F.col("created").alias("created_at"),
        F.col("active").alias("is_active"),
        main.alias("is_main_product"),
        F.col("nickname").alias("description"),
        "type",
        "billing_scheme",
        billing_cycle(F.col("recurring_interval"), F.col("recurring_interval_count"))
        .alias("billing_cycle"),
        "tiers_mode",
        "recurring_interval",
        "recurring_interval_count",
        cents_to_units("unit_amount").alias("unit_amount"),
        "product_id",
        F.col("unit_amount").alias("unit_amount_cents"),
    )


def stg_price(price: DataFrame, product: DataFrame, product_config: DataFrame) -> DataFrame:
    """Live prices with product name / main flag from the config and a cycle label."""
    return priced(price, product, product_config).select(*STG_PRICE_COLUMNS)


# --------------------------------------------------------------------------- tiers

def stg_tier(tier: DataFrame) -> DataFrame:
    """Price tiers renamed, amounts in units."""
    return tier.select(
        F.col("id").alias("price_id"),
        cents_to_units("flat_amount").alias("flat_amount"),
        cents_to_units("unit_amount").alias("unit_amount"),
        F.col("up_to").alias("up_to_quantity"),
        F.col("index").alias("order_index"),
    )


def tier_bounds(tier: DataFrame) -> DataFrame:
    """Tiers with the previous tier's bound (``lag`` within the price, by index).

    Every item of a price sees exactly that price's tier rows, so the lag taken
    per price equals the lag taken per item, and runs on the (small) tier table
    instead of the item × tier product.
    """
    w = Window.partitionBy("id").orderBy(F.col("index").asc_nulls_last())
    return tier.select(
        F.col("id").alias("price_id"),
        F.col("index").alias("order_index"),
        F.col("up_to"),
        F.lag("up_to").over(w).alias("prev_up_to"),
        F.col("flat_amount").alias("flat_cents"),
        F.col("unit_amount").alias("unit_cents"),
    )


def _item_tier_rows(item: DataFrame, prices: DataFrame, tier: DataFrame) -> DataFrame:
    """item ⟕ price ⟕ tier: one row per item and tier of its price (or one bare row)."""
    p = prices.select(F.col("id").alias("_price_id"), "billing_scheme", "unit_amount_cents")
    t = tier_bounds(tier)
    return (item.select(F.col("id").alias("item_id"), "quantity", "plan_id")
            .join(p, matches(F.col("plan_id"), F.col("_price_id"), F.col("item_id"),
                             F.col("quantity")), "left")
            .join(t, matches(F.col("_price_id"), F.col("price_id"), F.col("item_id"),
                             F.col("quantity")), "left"))


def _row_amount_cents(scheme: Column, quantity: Column, unit_cents: Column, up_to: Column,
                      prev_up_to: Column, flat_cents: Column, tier_unit_cents: Column) -> Column:
    """Amount of one item × tier row: per-unit price, or the tier's part; else NULL."""
    return (F.when(scheme == "per_unit", quantity * unit_cents)
            .when(scheme == "tiered",
                  tier_amount(quantity, up_to, prev_up_to, flat_cents, tier_unit_cents)))


def item_price_tiers(item: DataFrame, price: DataFrame, product: DataFrame,
                     product_config: DataFrame, tier: DataFrame) -> DataFrame:
    """One row per item and tier, with the previous tier's bound (reference shape)."""
    rows = _item_tier_rows(item, priced(price, product, product_config), tier)
    return rows.select(
        "item_id", "billing_scheme", "quantity",
        cents_to_units("unit_amount_cents").alias("unit_amount"),
        cents_to_units("flat_cents").alias("tier_flat_amount"),
        cents_to_units("unit_cents").alias("tier_unit_amount"),
        F.col("up_to").alias("tier_up_to_quantity"),
        F.col("prev_up_to").alias("tier_last_up_to_quantity"),
        "order_index",
    )


def tiered_price_amount(item: DataFrame, price: DataFrame, product: DataFrame,
                        product_config: DataFrame, tier: DataFrame) -> DataFrame:
    """``item_price_tiers`` plus the amount each row contributes (units)."""
    rows = _item_tier_rows(item, priced(price, product, product_config), tier)
    amount = _row_amount_cents(F.col("billing_scheme"), F.col("quantity"),
                               F.col("unit_amount_cents"), F.col("up_to"), F.col("prev_up_to"),
                               F.col("flat_cents"), F.col("unit_cents"))
    return rows.select(
        "item_id", "billing_scheme", "quantity",
        cents_to_units("unit_amount_cents").alias("unit_amount"),
        cents_to_units("flat_cents").alias("tier_flat_amount"),
        cents_to_units("unit_cents").alias("tier_unit_amount"),
        F.col("up_to").alias("tier_up_to_quantity"),
        F.col("prev_up_to").alias("tier_last_up_to_quantity"),
        "order_index",
        cents_to_units(amount).alias("amount"),
    )


def tier_steps(tier: DataFrame) -> DataFrame:
    """One row per price: its tiers in order of index (NULLs last), as an array of structs with
    the previous tier's bound."""
    step = F.struct(F.col("index").isNull().alias("last"), "index", "up_to",
                    F.col("flat_amount").alias("flat_cents"),
                    F.col("unit_amount").alias("unit_cents"))
    return (tier.where(F.col("id").isNotNull()).groupBy(F.col("id").alias("_tier_price_id"))
            .agg(F.array_sort(F.collect_list(step)).alias("_steps"))
            .select("_tier_price_id", F.transform("_steps", lambda x, i: F.struct(
                x["up_to"].alias("up_to"),
                F.get("_steps", i - 1)["up_to"].alias("prev_up_to"),
                x["flat_cents"].alias("flat_cents"),
                x["unit_cents"].alias("unit_cents"))).alias("steps")))


def _line_cents() -> Column:
    """The amount of one line: that of every tier of its price, added up (NULLs count for
    nothing; a price without tiers has one empty tier)."""
    one = F.array(F.struct(*[F.lit(None).cast("bigint").alias(c)
                             for c in ("up_to", "prev_up_to", "flat_cents", "unit_cents")]))

    def add(total: Column, x: Column) -> Column:
        part = _row_amount_cents(F.col("billing_scheme"), F.col("quantity"),
                                 F.col("unit_amount_cents"), x["up_to"], x["prev_up_to"],
                                 x["flat_cents"], x["unit_cents"])
        return F.coalesce(total + part, total, part)

    return F.aggregate(F.coalesce("steps", one), F.lit(None).cast("bigint"), add)


LINE_COLUMNS = ["id", "created", "quantity", "subscription_id", "plan_id", "product_name",
                "is_main_product", "billing_scheme", "recurring_interval",
                "recurring_interval_count", "description", "product_id"]


def priced_items(item: DataFrame, prices: DataFrame, tier: DataFrame) -> DataFrame:
    """Every subscription line with its price's attributes and its own amount (``line_cents``):
    the one join of lines with prices. A price's tiers travel as one array, so there is no row
    per line and tier. ``prices`` is :func:`priced`."""
    steps = tier_steps(tier)
    p = prices.join(steps, F.col("id") == F.col("_tier_price_id"), "left").select(
        F.col("id").alias("_price_id"), "product_name", "is_main_product", "billing_scheme",
        "recurring_interval", "recurring_interval_count", "description", "product_id",
        "unit_amount_cents", "steps")
    lines = item.select("id", "created", "quantity", "subscription_id", "plan_id").join(
        p, matches(F.col("plan_id"), F.col("_price_id"), F.col("id"), F.col("created")), "left")
    return lines.select(*LINE_COLUMNS, _line_cents().alias("line_cents"))


def _item_amount_cents(lines: DataFrame) -> DataFrame:
    """Sum of line amounts per item id (partially summed before its shuffle)."""
    return lines.groupBy(F.col("id").alias("item_id")).agg(
        F.sum("line_cents").alias("amount_cents"))


def item_amount(item: DataFrame, price: DataFrame, product: DataFrame,
                product_config: DataFrame, tier: DataFrame) -> DataFrame:
    """Sum of tier amounts per item (units)."""
    a = _item_amount_cents(priced_items(item, priced(price, product, product_config), tier))
    return a.select("item_id", cents_to_units("amount_cents").alias("amount"))


STG_ITEM_COLUMNS = [
    "id", "created_at", "product_name", "is_main_product", "price_billing_scheme",
    "price_recurring_interval", "price_recurring_interval_count", "price_description",
    "price_quantity", "price_amount", "subscription_id", "price_id", "product_id",
]


def stg_subscription_item(item: DataFrame, price: DataFrame, product: DataFrame,
                          product_config: DataFrame, tier: DataFrame) -> DataFrame:
    """Subscription lines with their price attributes and priced amount."""
    return items_with_amounts(priced_items(item, priced(price, product, product_config), tier))


def items_with_amounts(lines: DataFrame) -> DataFrame:
    """The model from :func:`priced_items` (a stored table of it is read twice; nothing is
    priced again).

    Amounts are summed per item id and joined back by id, as the reference does: lines that
    share an id share its whole sum, and a line without an id has no amount. The join is one
    that adaptive execution can split, if one id holds very many lines.
    """
    # the key is written anew so that the sums are shuffled once more, to the join: a join in the
    # aggregate's own stage cannot be split
    amounts = _item_amount_cents(lines).withColumn("item_id", F.concat("item_id", F.lit("")))
    src = lines.join(amounts, matches(F.col("id"), F.col("item_id"), F.col("plan_id"),
                                      F.col("subscription_id"), F.col("created")), "left")
    return src.select(
        "id",
        F.col("created").alias("created_at"),
        "product_name",
        "is_main_product",
        F.col("billing_scheme").alias("price_billing_scheme"),
        F.col("recurring_interval").alias("price_recurring_interval"),
        F.col("recurring_interval_count").alias("price_recurring_interval_count"),
        F.col("description").alias("price_description"),
        F.col("quantity").alias("price_quantity"),
        cents_to_units("amount_cents").alias("price_amount"),
        "subscription_id",
        F.col("plan_id").alias("price_id"),
        "product_id",
    )


# --------------------------------------------------------------------------- subscription

def _plans(items: DataFrame) -> DataFrame:
    """Per subscription: the total of all its items, and its oldest main-product item.

    One ``groupBy(subscription_id)`` does both (``min_by`` over main items ordered by
    created_at, NULLs last, then item id), so both are partially aggregated before the
    shuffle: a subscription with a huge number of items never lands in one task as raw
    rows, which a ``row_number`` window would make it do.
    """
    is_main = F.coalesce(F.col("is_main_product"), F.lit(False))
    plan = F.struct(
        F.col("product_name"),
        F.col("price_description").alias("plan_description"),
        F.col("price_billing_scheme").alias("plan_billing_scheme"),
        F.col("price_recurring_interval").alias("plan_recurring_interval"),
        F.col("price_recurring_interval_count").alias("plan_recurring_interval_count"),
        F.col("price_id"),
        F.col("product_id"),
    )
    order = F.struct(F.col("created_at").isNull(), F.col("created_at"), F.col("id"))
    return (items.groupBy("subscription_id")
            .agg(F.sum(to_cents("price_amount")).alias("_cents"),
                 F.min_by(F.when(is_main, plan), F.when(is_main, order)).alias("_plan")))


def plan_amount(items: DataFrame) -> DataFrame:
    """Total of all prices of a subscription, add-ons included (units)."""
    return _plans(items).select("subscription_id", cents_to_units("_cents").alias("amount"))


PLAN_COLUMNS = [
    "subscription_id", "product_name", "plan_description", "plan_billing_scheme",
    "plan_recurring_interval", "plan_recurring_interval_count", "plan_amount", "price_id",
    "product_id",
]


def main_plan(items: DataFrame) -> DataFrame:
    """The plan of each subscription: its oldest main-product item, priced at the
    total of all its items."""
    # the total is attached by subscription id, which a NULL id never matches
    total = F.when(F.col("subscription_id").isNotNull(), cents_to_units("_cents"))
    return (_plans(items).where(F.col("_plan").isNotNull())
            .select("subscription_id", "_plan.*", total.alias("plan_amount"))
            .select(*PLAN_COLUMNS))


STG_SUBSCRIPTION_COLUMNS = [
    "id", "customer_name", "product_name", "created_at", "billing_cycle_anchored_at",
    "cancel_at", "current_period_started_at", "current_period_end_at", "trial_started_at",
    "trial_end_at", "is_cancel_at_period_end", "status", "collection_method",
    "plan_billing_scheme", "plan_recurring_interval", "plan_recurring_interval_count",
    "plan_description", "plan_amount", "annual_value", "stripe_customer_id", "price_id",
    "product_id",
]


def stg_subscription(subscription_history: DataFrame, customers: DataFrame,
                     items: DataFrame) -> DataFrame:
    """Current live subscriptions with customer name, plan and annual value.

    ``customers`` is ``stg_customer``; ``items`` is ``stg_subscription_item``.
    """
    plans = main_plan(items)
    names = customers.select(F.col("id").alias("_cust_id"), F.col("name").alias("customer_name"))
    live = subscription_history.where(F.col("livemode") & F.col("_fivetran_active"))
    src = (live.join(plans, live.id == plans.subscription_id, "left")
           .join(names, matches(F.col("customer_id"), F.col("_cust_id"), live.id), "left"))
    return src.select(
        live.id,
        "customer_name",
        "product_name",
        F.col("created").alias("created_at"),
        F.col("billing_cycle_anchor").alias("billing_cycle_anchored_at"),
        F.coalesce("cancel_at", "canceled_at").alias("cancel_at"),
        F.col("current_period_start").alias("current_period_started_at"),
        F.col("current_period_end").alias("current_period_end_at"),
        F.col("trial_start").alias("trial_started_at"),
        F.col("trial_end").alias("trial_end_at"),
        F.col("cancel_at_period_end").alias("is_cancel_at_period_end"),
        "status",
        "collection_method",
        "plan_billing_scheme",
        "plan_recurring_interval",
        "plan_recurring_interval_count",
        "plan_description",
        "plan_amount",
        cents_to_units(annual_value(F.col("plan_recurring_interval"),
                                    F.col("plan_recurring_interval_count"),
                                    to_cents("plan_amount"))).alias("annual_value"),
        F.col("customer_id").alias("stripe_customer_id"),
        "price_id",
        "product_id",
    )


# --------------------------------------------------------------------------- invoice

def live_invoices(invoice: DataFrame) -> DataFrame:
    """Live, undeleted invoices (the part of ``stg_invoice`` revenue needs)."""
    return _live(invoice)


def stg_invoice(invoice: DataFrame, customers: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Live invoices with customer and product names, money in units."""
    names = customers.select(F.col("id").alias("_cust_id"), F.col("name").alias("customer_name"))
    prods = subscriptions.select(F.col("id").alias("_sub_id"), "product_name")
    inv = live_invoices(invoice)
    src = (inv
           .join(names, matches(inv.customer_id, F.col("_cust_id"), inv.id), "left")
           .join(prods, matches(inv.subscription_id, F.col("_sub_id"), inv.id), "left"))
    return src.select(
        "id", "customer_name", "product_name",
        F.col("number").alias("reference_number"),
        F.col("created").alias("created_at"),
        F.col("period_start").alias("period_started_at"),
        F.col("period_end").alias("period_ended_at"),
        F.col("due_date").alias("due_at"),
        F.col("paid").alias("is_paid"),
        F.col("auto_advance").alias("is_auto_advance"),
        F.col("attempted").alias("is_attempted"),
        "status", "collection_method",
        cents_to_units("total").alias("total"),
        cents_to_units("amount_due").alias("amount_due"),
        cents_to_units("amount_paid").alias("amount_paid"),
        cents_to_units("amount_remaining").alias("amount_remaining"),
        "attempt_count", "description", "footer", "customer_id", "subscription_id", "charge_id",
    )
