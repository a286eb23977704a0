"""The seven retail entities as queries over the given star-schema tables.

Each text is valid both in Spark SQL and in the SQL of the engine used for checking; table names are
placeholders. Some rows break the contracts on purpose, and some refer to a parent that does not exist.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _padded(number: str, width: int) -> str:
    """Number as text of at least ``width`` digits; longer numbers keep all their digits."""
    text = f"cast({number} as string)"
    return f"lpad({text}, cast(greatest({width}, length({text})) as int), '0')"


def _id(prefix: str, number: str, width: int) -> str:
    return f"'{prefix}-' || {_padded(number, width)}"


_CUSTOMERS = f"""
select {_id('CUSTOMER', 'c_custkey', 6)} as customer_id,
       'First' || cast(c_custkey % 97 as string) as first_name,
       case when c_custkey % 173 = 5 then null else c_name end as last_name,
       case when c_custkey % 50 = 0 then null
            when c_custkey % 50 = 1 then c_name
            else lower(replace(c_name, '#', '.')) || '@example.com' end as email,
       '+44 ' || {_padded('c_custkey % 100000', 5)} as phone_number,
       n_name as city,
       r_name as region,
       {_padded('c_custkey % 1000', 5)} as postal_code,
       cast(c_custkey % 250 as string) || ' "High" Street,' || chr(10) || n_name as address,
       case when c_custkey % 25 = 4 then 'diamond'
            when c_custkey % 5 = 0 then 'Bronze'
            when c_custkey % 5 = 1 then 'Silver'
            when c_custkey % 5 = 2 then 'Gold'
            else 'Platinum' end as loyalty_tier,
       cast(date '1994-01-01' + cast(c_custkey % 365 as int) as timestamp) as creation_datetime,
       c_acctbal >= 0 as is_active
from {{customer}}
join {{nation}} on c_nationkey = n_nationkey
join {{region}} on n_regionkey = r_regionkey
"""

_STORES = f"""
select {_id('STORE', 's_suppkey', 4)} as store_id,
       s_name as store_name,
       n_name as city,
       r_name as region,
       case when s_suppkey % 41 = 7 then null else {_padded('s_suppkey % 1000', 5)} end
           as postal_code,
       case when s_suppkey % 29 = 3 then 'kiosk'
            when s_suppkey % 4 = 0 then 'convenience'
            when s_suppkey % 4 = 1 then 'standard'
            when s_suppkey % 4 = 2 then 'flagship'
            else 'warehouse' end as store_format,
       date '1990-01-01' + cast(s_suppkey % 1000 as int) as opening_date,
       s_acctbal >= 0 as is_active
from {{supplier}}
join {{nation}} on s_nationkey = n_nationkey
join {{region}} on n_regionkey = r_regionkey
"""

_PRODUCTS = f"""
select {_id('PRODUCT', 'p_partkey', 6)} as product_id,
       case when p_partkey % 301 = 11 then null
            else 'SKU' || cast(p_partkey - case when p_partkey % 401 = 1 then 1 else 0 end as string)
            end as sku,
       p_name as product_name,
       case p_type when 'ECONOMY' then 'Grocery'
                   when 'MEDIUM' then 'Electronics'
                   when 'STANDARD' then 'Clothing'
                   when 'SMALL' then 'Home'
                   when 'LARGE' then 'Health'
                   else p_type end as category,
       p_type || '/' || cast(p_size as string) as subcategory,
       p_brand as brand,
       floor(p_retailprice * 100 + 0.5e0) / 1e2 as unit_price,
       case when p_partkey % 211 = 3 then -1e0
            else floor(p_retailprice * 100 + 0.5e0) * 70 / 1e4 end as cost_price,
       p_size > 1 as is_active,
       cast(date '1994-06-01' + cast(p_partkey % 200 as int) as timestamp) as creation_datetime
from {{part}}
"""

_ORDERS = f"""
select {_id('ORDER', 'o_orderkey', 8)} as order_id,
       case when o_orderkey % 157 = 11 then {_id('CUSTOMER', 'o_custkey + 900000', 6)} else {_id('CUSTOMER', 'o_custkey', 6)} end as customer_id,
       case when o_orderkey % 3 = 1 then {_id('STORE', 'o_orderkey % 10', 4)} end as store_id,
       case when o_orderkey % 499 = 9 then 'phone'
            when o_orderkey % 3 = 0 then 'online'
            when o_orderkey % 3 = 1 then 'store'
            else 'mobile_app' end as channel,
       case o_orderstatus when 'F' then 'fulfilled'
                          when 'O' then 'confirmed'
                          when 'P' then 'returned' end as status,
       cast(o_orderdate as timestamp) as order_timestamp,
       case when o_orderkey % 211 = 2 then null else 'GBP' end as currency,
       floor(o_totalprice * 100 + 0.5e0) / 1e2 as gross_amount,
       case when o_orderkey % 333 = 7 then -1e0 else 0e0 end as discount_amount,
       floor(o_totalprice * 100 + 0.5e0) / 1e2 as net_amount,
       floor(o_totalprice * 100 + 0.5e0) * 20 / 1e4 as tax_amount,
       case when o_orderkey % 97 = 0 then 'cheque'
            when o_orderkey % 6 = 0 then 'credit_card'
            when o_orderkey % 6 = 1 then 'debit_card'
            when o_orderkey % 6 = 2 then 'paypal'
            when o_orderkey % 6 = 3 then 'gift_card'
            when o_orderkey % 6 = 4 then 'apple_pay'
            else 'google_pay' end as payment_method,
       case when o_orderkey % 3 = 0 then 'ecommerce_platform'
            when o_orderkey % 3 = 1 then 'pos_system'
            else 'mobile_app' end as created_by_system,
       cast(o_orderdate as date) as source_file_date,
       case when o_orderkey % 10 = 0
            then 'Note "' || o_orderpriority || '",' || chr(10) || 'second line' end as customer_note
from {{orders}}
"""

# Whole cents and per cents, so that amounts come out of exact arithmetic in both engines.
_CENTS = "cast(floor(l_extendedprice * 100 + 0.5e0) as bigint)"
_DISCOUNT_PCT = "cast(floor(l_discount * 100 + 0.5e0) as bigint)"
_TAX_PCT = "cast(floor(l_tax * 100 + 0.5e0) as bigint)"

_ORDER_ITEMS = f"""
select {_id('ORDER', 'l_orderkey', 8)} || '-' || {_padded('l_linenumber', 3)} as order_item_id,
       case when l_orderkey % 263 = 17 then {_id('ORDER', 'l_orderkey + 90000000', 8)} else {_id('ORDER', 'l_orderkey', 8)} end as order_id,
       l_linenumber as line_number,
       case when l_partkey % 197 = 5 then {_id('PRODUCT', 'l_partkey + 900000', 6)} else {_id('PRODUCT', 'l_partkey', 6)} end as product_id,
       cast(l_quantity as int) as quantity,
       floor({_CENTS} / l_quantity) / 1e2 as unit_price,
       {_CENTS} / 1e2 as gross_amount,
       {_CENTS} * {_DISCOUNT_PCT} / 1e4 as discount_amount,
       {_CENTS} * (100 - {_DISCOUNT_PCT}) / 1e4 as net_amount,
       {_CENTS} * (100 - {_DISCOUNT_PCT}) * {_TAX_PCT} / 1e6 as tax_amount
from {{lineitem}}
"""

_INVENTORY = f"""
select 'INV-' || cast(l_suppkey as string) || '-' || cast(l_partkey as string)
           as inventory_snapshot_id,
       case when (l_suppkey + l_partkey) % 311 = 3 then {_id('STORE', 'l_suppkey + 9000', 4)} else {_id('STORE', 'l_suppkey', 4)} end as store_id,
       case when (l_suppkey + l_partkey) % 307 = 2 then {_id('PRODUCT', 'l_partkey + 900000', 6)} else {_id('PRODUCT', 'l_partkey', 6)} end as product_id,
       cast(max(l_shipdate) as date) as snapshot_date,
       cast(cast(sum(l_quantity) as bigint) % 60 as int) as stock_on_hand,
       cast(10 + 5 * (l_partkey % 5) as int) as reorder_point,
       cast(case when l_partkey % 83 = 4 then 0 else 50 + 25 * (l_partkey % 4) end as int)
           as reorder_quantity,
       cast(sum(l_quantity) as bigint) % 60 = 0 as is_stockout,
       case when l_partkey % 71 = 0 then false
            else cast(sum(l_quantity) as bigint) % 60 < 10 + 5 * (l_partkey % 5) end
           as is_below_reorder_point
from {{lineitem}}
group by l_suppkey, l_partkey
"""

_PROMOTIONS = f"""
select {_id('PROMO', 'p_partkey', 4)} as promotion_id,
       p_name || ' deal' as promotion_name,
       case when p_partkey % 53 = 7 then {_id('PRODUCT', 'p_partkey + 900000', 6)} else {_id('PRODUCT', 'p_partkey', 6)} end as product_id,
       cast(5 * (p_size % 6) as int) as discount_pct,
       date '1996-01-01' + cast(p_partkey % 365 as int) as start_date,
       date '1996-01-01' + cast(p_partkey % 365 + 700 as int) as end_date,
       case when p_partkey % 4 = 0 then 'ALL '
            when p_partkey % 4 = 1 then 'online'
            when p_partkey % 4 = 2 then ' store'
            else 'mobile_app' end as channel,
       p_size <= 25 as is_active
from {{part}}
"""

ENTITY_SQL: dict[str, str] = {
    "customers": _CUSTOMERS,
    "stores": _STORES,
    "products": _PRODUCTS,
    "orders": _ORDERS,
    "order_items": _ORDER_ITEMS,
    "inventory_snapshots": _INVENTORY,
    "promotions": _PROMOTIONS,
}


def read_entity(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """One entity, before conforming and deduplication, read from the parquet tables in a folder."""
    text = ENTITY_SQL[entity]
    used = [t for t in SOURCE_TABLES if f"{{{t}}}" in text]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    return spark.sql(text, **tables)
