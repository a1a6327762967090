"""DuckDB SQL of the derived billing tables (the FIXTURES.md blocks, unchanged).

Read the driver's test tables ``region nation customer part orders``.
"""

SRC = {}

SRC["src_customer"] = """
select concat('cus_', cast(c_custkey as string)) as id
  , case when c_custkey % 10 = 0 then null else c_name end as name
  , case when c_custkey % 20 = 0 then concat('desc ', c_name) end as description
  , concat('User', cast(c_custkey as string), '@Example.COM') as email
  , cast('1995-01-01' as timestamp) as created
  , case when c_custkey % 4 = 0 then null else n_name end as address_country
  , c_mktsegment as address_state
  , case when c_custkey % 6 = 0 then null else concat('City', cast(c_nationkey as string)) end as address_city
  , cast(c_custkey % 1000 as string) as address_postal_code
  , case when c_custkey % 8 = 0 then r_name end as shipping_address_country
  , cast(null as string) as shipping_address_state
  , 'ShipCity' as shipping_address_city
  , cast(null as string) as shipping_address_postal_code
  , c_acctbal < 0 as delinquent
  , concat('INV', cast(c_custkey as string)) as invoice_prefix
  , cast(round(c_acctbal * 100) as bigint) as balance
  , concat('card_', cast(c_custkey as string)) as default_card_id
  , c_custkey % 50 <> 49 as livemode
  , c_custkey % 50 = 48 as is_deleted
from customer
join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey
"""

SRC["src_card"] = """
select concat('card_', cast(c_custkey as string)) as id
  , concat('C', cast(c_nationkey as string)) as country
from customer
where c_custkey % 3 <> 0
"""

SRC["src_product"] = """
select distinct concat('prod_', p_type) as id, p_type as name
from part
"""

SRC["src_product_config"] = """
select id as product_id
  , case when name = 'PROMO' then 'Promo Plan' else name end as name
  , name not in ('SMALL', 'MEDIUM') as is_main_product
from src_product
where name <> 'LARGE'
"""

SRC["src_price"] = """
select concat('price_', cast(p_partkey as string)) as id
  , cast('1995-01-01' as timestamp) as created
  , p_size < 45 as active
  , p_name as nickname
  , 'recurring' as type
  , case when p_size % 4 = 0 then 'tiered' else 'per_unit' end as billing_scheme
  , case when p_partkey % 40 = 27 then 'week' when p_partkey % 10 in (3, 4, 9) then 'year' else 'month' end as recurring_interval
  , cast(case when p_partkey % 20 = 18 then 6 when p_partkey % 10 = 8 then 3 when p_partkey % 10 = 9 then 2 else 1 end as bigint) as recurring_interval_count
  , case when p_size % 4 = 0 then case when p_size % 8 = 0 then 'volume' else 'graduated' end end as tiers_mode
  , cast(round(p_retailprice * 100) as bigint) as unit_amount
  , case when p_size = 47 then null else concat('prod_', p_type) end as product_id
  , p_size <> 50 as livemode
  , p_size = 49 as is_deleted
from part
"""

SRC["src_tier"] = """
select p.id as id
  , t.idx as index
  , t.up_to as up_to
  , case when t.idx = 1 and p.tiers_mode = 'volume' then cast(500000 as bigint) end as flat_amount
  , p.unit_amount - t.idx * 10000 as unit_amount
from src_price p
cross join (
  select cast(0 as bigint) as idx, cast(10 as bigint) as up_to
  union all select cast(1 as bigint), cast(25 as bigint)
  union all select cast(2 as bigint), cast(null as bigint)
) t
where p.billing_scheme = 'tiered'
"""

SRC["src_subscription_history"] = """
select concat('sub_', cast(c_custkey as string), s.leg) as id
  , cast(date '1995-01-01' + cast((c_custkey * 37 + s.off) % 2200 as int) as timestamp) as created
  , cast(date '1995-01-01' + cast((c_custkey * 37 + s.off) % 2200 as int) as timestamp) as billing_cycle_anchor
  , case when c_custkey % 5 = 0 and c_custkey % 4 <> 1 then cast(date '1995-01-01' + cast((c_custkey * 37 + s.off) % 2200 + (case when c_custkey % 2 = 0 then 7 else 200 end) as int) as timestamp) end as cancel_at
  , case when c_custkey % 5 = 0 then cast(date '1995-01-01' + cast((c_custkey * 37 + s.off) % 2200 + 200 as int) as timestamp) end as canceled_at
  , cast(date '2000-01-01' as timestamp) as current_period_start
  , case when c_custkey % 11 = 0 then cast(null as timestamp) else cast(date '2000-06-01' + cast((c_custkey * 13) % 800 as int) as timestamp) end as current_period_end
  , case when c_custkey % 3 = 1 then cast(date '1995-01-01' + cast((c_custkey * 37 + s.off) % 2200 as int) as timestamp) end as trial_start
  , case when c_custkey % 3 = 1 then cast(date '1995-01-01' + cast((c_custkey * 37 + s.off) % 2200 + 14 as int) as timestamp) end as trial_end
  , case when c_custkey % 43 = 3 then cast(null as boolean) else c_custkey % 7 = 0 end as cancel_at_period_end
  , case when c_custkey % 31 = 5 then 'trialing' when c_custkey % 5 = 0 then 'canceled' else 'active' end as status
  , 'charge_automatically' as collection_method
  , concat('cus_', cast(c_custkey as string)) as customer_id
  , c_custkey % 53 <> 9 as livemode
  , c_custkey % 41 <> 7 as _fivetran_active
from customer
cross join (select 'a' as leg, 0 as off union all select 'b', 400) s
where s.leg = 'a' or c_custkey % 3 = 0
"""

SRC["src_subscription_item"] = """
select concat('si_', cast(c_custkey as string), s.leg, cast(k.n as string)) as id
  , cast(date '1995-01-01' + cast((c_custkey * 37) % 2200 as int) as timestamp) as created
  , cast(1 + (c_custkey + k.n * 5) % 40 as bigint) as quantity
  , concat('sub_', cast(c_custkey as string), s.leg) as subscription_id
  , concat('price_', cast((c_custkey * 7 + k.n * 3 + s.off) % n_parts as string)) as plan_id
from customer
cross join (select 'a' as leg, 0 as off union all select 'b', 1) s
cross join (select 0 as n union all select 1) k
cross join (select count(*) as n_parts from part) np
where (s.leg = 'a' or c_custkey % 3 = 0) and (k.n = 0 or c_custkey % 4 = 0)
"""

SRC["src_invoice"] = """
select concat('in_', cast(o_orderkey as string)) as id
  , concat('N-', cast(o_orderkey as string)) as number
  , cast(o_orderdate as timestamp) as created
  , cast(o_orderdate as timestamp) as period_start
  , cast(o_orderdate as timestamp) as period_end
  , cast(null as timestamp) as due_date
  , o_orderstatus = 'F' as paid
  , true as auto_advance
  , o_orderstatus <> 'O' as attempted
  , case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then 'void'
         when o_orderstatus = 'P' and o_orderpriority = '4-NOT SPECIFIED' then 'uncollectible'
         when o_orderkey % 89 = 0 then cast(null as string)
         when o_orderstatus = 'O' then 'open' else 'paid' end as status
  , 'charge_automatically' as collection_method
  , case when o_orderkey % 97 = 0 then -1 else 1 end * cast(round(o_totalprice * 100) as bigint) as total
  , cast(round(o_totalprice * 100) as bigint) as amount_due
  , case when o_orderstatus = 'F' then cast(round(o_totalprice * 100) as bigint) else cast(0 as bigint) end as amount_paid
  , case when o_orderstatus = 'F' then cast(0 as bigint) else cast(round(o_totalprice * 100) as bigint) end as amount_remaining
  , cast(1 as bigint) as attempt_count
  , cast(null as string) as description
  , cast(null as string) as footer
  , case when o_orderkey % 499 = 0 then cast(null as string) else concat('cus_', cast(o_custkey as string)) end as customer_id
  , concat('sub_', cast(o_custkey as string), case when o_custkey % 3 = 0 and o_orderkey % 2 = 1 then 'b' else 'a' end) as subscription_id
  , concat('ch_', cast(o_orderkey as string)) as charge_id
  , o_orderkey % 101 <> 0 as livemode
  , o_orderkey % 103 = 0 as is_deleted
from orders
"""
