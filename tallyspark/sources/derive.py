"""Billing tables derived from the driver's TPC-H-style test data.

The reference ships no data, so the eight billing inputs are derived from the
test tables ``region nation customer part orders`` by the rules written down in
FIXTURES.md (one rule set per table). Everything here is lazy DataFrame code: the
derived tables grow with the test tables and are never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.sources.readers import BillingTables, conform


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _rows(*rows: dict) -> Column:
    """A literal array of structs, exploded in place of a join to constant rows."""
    return F.explode(F.array(*[
        F.struct(*[F.lit(v).alias(k) for k, v in r.items()]) for r in rows]))


def derive_customer(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    src = (customer
           .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
           .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    return conform(src.selectExpr(
        "concat('cus_', cast(c_custkey as string)) as id",
        "case when c_custkey % 10 = 0 then null else c_name end as name",
        "case when c_custkey % 20 = 0 then concat('desc ', c_name) end as description",
        "concat('User', cast(c_custkey as string), '@Example.COM') as email",
        "cast('1995-01-01' as timestamp) as created",
        "case when c_custkey % 4 = 0 then null else n_name end as address_country",
        "c_mktsegment as address_state",
        "case when c_custkey % 6 = 0 then null "
        "else concat('City', cast(c_nationkey as string)) end as address_city",
        "cast(c_custkey % 1000 as string) as address_postal_code",
        "case when c_custkey % 8 = 0 then r_name end as shipping_address_country",
        "cast(null as string) as shipping_address_state",
        "'ShipCity' as shipping_address_city",
        "cast(null as string) as shipping_address_postal_code",
        "c_acctbal < 0 as delinquent",
        "concat('INV', cast(c_custkey as string)) as invoice_prefix",
        "cast(round(c_acctbal * 100) as bigint) as balance",
        "concat('card_', cast(c_custkey as string)) as default_card_id",
        "c_custkey % 50 <> 49 as livemode",
        "c_custkey % 50 = 48 as is_deleted",
    ), "customer")


def derive_card(customer: DataFrame) -> DataFrame:
    return conform(customer.where("c_custkey % 3 <> 0").selectExpr(
        "concat('card_', cast(c_custkey as string)) as id",
        "concat('C', cast(c_nationkey as string)) as country",
    ), "card")


def derive_product(part: DataFrame) -> DataFrame:
    return conform(part.selectExpr("concat('prod_', p_type) as id", "p_type as name")
                   .distinct(), "product")


def derive_product_config(product: DataFrame) -> DataFrame:
    return conform(product.where("name <> 'LARGE'").selectExpr(
        "id as product_id",
        "case when name = 'PROMO' then 'Promo Plan' else name end as name",
        "name not in ('SMALL', 'MEDIUM') as is_main_product",
    ), "product_config")


def derive_price(part: DataFrame) -> DataFrame:
    return conform(part.selectExpr(
        "concat('price_', cast(p_partkey as string)) as id",
        "cast('1995-01-01' as timestamp) as created",
        "p_size < 45 as active",
        "p_name as nickname",
        "'recurring' as type",
        "case when p_size % 4 = 0 then 'tiered' else 'per_unit' end as billing_scheme",
        "case when p_partkey % 40 = 27 then 'week' "
        "when p_partkey % 10 in (3, 4, 9) then 'year' else 'month' end as recurring_interval",
        "cast(case when p_partkey % 20 = 18 then 6 when p_partkey % 10 = 8 then 3 "
        "when p_partkey % 10 = 9 then 2 else 1 end as bigint) as recurring_interval_count",
        "case when p_size % 4 = 0 then case when p_size % 8 = 0 then 'volume' "
        "else 'graduated' end end as tiers_mode",
        "cast(round(p_retailprice * 100) as bigint) as unit_amount",
        "case when p_size = 47 then null else concat('prod_', p_type) end as product_id",
        "p_size <> 50 as livemode",
        "p_size = 49 as is_deleted",
    ), "price")


def derive_tier(price: DataFrame) -> DataFrame:
    # three tiers per tiered price: up to 10, up to 25, open-ended
    tiers = _rows({"idx": 0, "up_to": 10}, {"idx": 1, "up_to": 25}, {"idx": 2, "up_to": None})
    return conform(price.where("billing_scheme = 'tiered'")
                   .select("*", tiers.alias("t"))
                   .selectExpr(
                       "id",
                       "cast(t.idx as bigint) as index",
                       "cast(t.up_to as bigint) as up_to",
                       "case when t.idx = 1 and tiers_mode = 'volume' "
                       "then cast(500000 as bigint) end as flat_amount",
                       "unit_amount - t.idx * 10000 as unit_amount"), "tier")


def derive_subscription_history(customer: DataFrame) -> DataFrame:
    legs = _rows({"leg": "a", "off": 0}, {"leg": "b", "off": 400})
    day = "(c_custkey * 37 + s.off) % 2200"
    return conform(customer.select("*", legs.alias("s"))
                   .where("s.leg = 'a' or c_custkey % 3 = 0")
                   .selectExpr(
        "concat('sub_', cast(c_custkey as string), s.leg) as id",
        f"cast(date '1995-01-01' + cast({day} as int) as timestamp) as created",
        f"cast(date '1995-01-01' + cast({day} as int) as timestamp) as billing_cycle_anchor",
        "case when c_custkey % 5 = 0 and c_custkey % 4 <> 1 then "
        f"cast(date '1995-01-01' + cast({day} + "
        "(case when c_custkey % 2 = 0 then 7 else 200 end) as int) as timestamp) end as cancel_at",
        "case when c_custkey % 5 = 0 then "
        f"cast(date '1995-01-01' + cast({day} + 200 as int) as timestamp) end as canceled_at",
        "cast(date '2000-01-01' as timestamp) as current_period_start",
        "case when c_custkey % 11 = 0 then cast(null as timestamp) else "
        "cast(date '2000-06-01' + cast((c_custkey * 13) % 800 as int) as timestamp) end "
        "as current_period_end",
        "case when c_custkey % 3 = 1 then "
        f"cast(date '1995-01-01' + cast({day} as int) as timestamp) end as trial_start",
        "case when c_custkey % 3 = 1 then "
        f"cast(date '1995-01-01' + cast({day} + 14 as int) as timestamp) end as trial_end",
        "case when c_custkey % 43 = 3 then cast(null as boolean) else c_custkey % 7 = 0 end "
        "as cancel_at_period_end",
        "case when c_custkey % 31 = 5 then 'trialing' when c_custkey % 5 = 0 then 'canceled' "
        "else 'active' end as status",
        "'charge_automatically' as collection_method",
        "concat('cus_', cast(c_custkey as string)) as customer_id",
        "c_custkey % 53 <> 9 as livemode",
        "c_custkey % 41 <> 7 as _fivetran_active",
    ), "subscription_history")


def derive_subscription_item(customer: DataFrame, part: DataFrame) -> DataFrame:
    legs = _rows({"leg": "a", "off": 0}, {"leg": "b", "off": 1})
    ks = F.explode(F.array(F.lit(0), F.lit(1)))
    # number of parts, as a scalar subquery evaluated by Spark (never collected)
    n_parts = part.select(F.count(F.lit(1))).scalar()
    return conform(customer.select("*", legs.alias("s"))
                   .select("*", ks.alias("k"))
                   .where("(s.leg = 'a' or c_custkey % 3 = 0) and (k = 0 or c_custkey % 4 = 0)")
                   .withColumn("n_parts", n_parts)
                   .selectExpr(
        "concat('si_', cast(c_custkey as string), s.leg, cast(k as string)) as id",
        "cast(date '1995-01-01' + cast((c_custkey * 37) % 2200 as int) as timestamp) as created",
        "cast(1 + (c_custkey + k * 5) % 40 as bigint) as quantity",
        "concat('sub_', cast(c_custkey as string), s.leg) as subscription_id",
        "concat('price_', cast((c_custkey * 7 + k * 3 + s.off) % n_parts as string)) as plan_id",
    ), "subscription_item")


def derive_invoice(orders: DataFrame) -> DataFrame:
    cents = "cast(round(o_totalprice * 100) as bigint)"
    return conform(orders.selectExpr(
        "concat('in_', cast(o_orderkey as string)) as id",
        "concat('N-', cast(o_orderkey as string)) as number",
        "cast(o_orderdate as timestamp) as created",
        "cast(o_orderdate as timestamp) as period_start",
        "cast(o_orderdate as timestamp) as period_end",
        "cast(null as timestamp) as due_date",
        "o_orderstatus = 'F' as paid",
        "true as auto_advance",
        "o_orderstatus <> 'O' as attempted",
        "case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then 'void' "
        "when o_orderstatus = 'P' and o_orderpriority = '4-NOT SPECIFIED' then 'uncollectible' "
        "when o_orderkey % 89 = 0 then cast(null as string) "
        "when o_orderstatus = 'O' then 'open' else 'paid' end as status",
        "'charge_automatically' as collection_method",
        f"case when o_orderkey % 97 = 0 then -1 else 1 end * {cents} as total",
        f"{cents} as amount_due",
        f"case when o_orderstatus = 'F' then {cents} else cast(0 as bigint) end as amount_paid",
        f"case when o_orderstatus = 'F' then cast(0 as bigint) else {cents} end "
        "as amount_remaining",
        "cast(1 as bigint) as attempt_count",
        "cast(null as string) as description",
        "cast(null as string) as footer",
        "case when o_orderkey % 499 = 0 then cast(null as string) "
        "else concat('cus_', cast(o_custkey as string)) end as customer_id",
        "concat('sub_', cast(o_custkey as string), "
        "case when o_custkey % 3 = 0 and o_orderkey % 2 = 1 then 'b' else 'a' end) "
        "as subscription_id",
        "concat('ch_', cast(o_orderkey as string)) as charge_id",
        "o_orderkey % 101 <> 0 as livemode",
        "o_orderkey % 103 = 0 as is_deleted",
    ), "invoice")


def derive_billing_tables(spark: SparkSession, sf_dir: str) -> BillingTables:
    """All nine billing inputs, derived lazily from the test tables in ``sf_dir``."""
    customer = _read(spark, sf_dir, "customer")
    part = _read(spark, sf_dir, "part")
    product = derive_product(part)
    price = derive_price(part)
    return BillingTables(
        customer=derive_customer(customer, _read(spark, sf_dir, "nation"),
                                 _read(spark, sf_dir, "region")),
        card=derive_card(customer),
        product=product,
        product_config=derive_product_config(product),
        price=price,
        tier=derive_tier(price),
        subscription_item=derive_subscription_item(customer, part),
        subscription_history=derive_subscription_history(customer),
        invoice=derive_invoice(_read(spark, sf_dir, "orders")),
    )
