"""The expected result of each query as SQL over the given tables.

Layers are named common table expressions; ``expand`` puts in front of a text those it uses.
"""

from __future__ import annotations

import re

from conformance.adapter import ENTITY_SQL, SOURCE_TABLES
from conformance.queries import FAILED_ROWS
from shelfstrata.contracts import CONTRACTS, MODEL_TESTS, RELATIONSHIPS
from shelfstrata.operators.rules import Rule
from shelfstrata.schemas import ENTITIES

_SQL_TYPES = {
    "string": "varchar",
    "int": "integer",
    "double": "double",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp",
}
NULL_PART = "'_dbt_utils_surrogate_key_null_'"


def _text(value) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def _columns(entity: str) -> list[str]:
    return ENTITIES[entity].column_names


def _key(*columns: str) -> str:
    parts = [f"coalesce(cast({c} as varchar), {NULL_PART})" for c in columns]
    return "md5(" + " || '-' || ".join(parts) + ")"


LAYERS: dict[str, str] = {}

for _e, _entity in ENTITIES.items():
    LAYERS[f"raw_{_e}"] = ENTITY_SQL[_e].format(**{t: t for t in SOURCE_TABLES})
    LAYERS[f"typed_{_e}"] = "select {} from raw_{}".format(
        ", ".join(f"try_cast({c} as {_SQL_TYPES[k]}) as {c}" for c, k in _entity.columns), _e
    )
    _rest = [c for c in _columns(_e) if c not in (*_entity.key, *_entity.recency)]
    _order = ", ".join(f"{c} desc nulls last" for c in (*_entity.recency, *_rest))
    LAYERS[f"silver_{_e}"] = (
        f"select {', '.join(_columns(_e))} from (select *, row_number() over "
        f"(partition by {_entity.key[0]} order by {_order}) as rn from typed_{_e}) where rn = 1"
    )
    LAYERS[f"stg_{_e}"] = f"select * from silver_{_e}"

LAYERS["stg_orders"] = "select *, cast(order_timestamp as date) as order_date from silver_orders"
LAYERS["stg_promotions"] = (
    "select * replace (lower(trim(channel)) as channel) from silver_promotions"
)
# The columns of the joined models, which are what is checked, in their order.
_REVENUE_COLUMNS = """
order_item_id order_id customer_id store_id status channel order_timestamp order_date currency product_id category
subcategory brand line_number quantity unit_price gross_amount discount_amount net_amount tax_amount cost_price
""".split()
_POSITION_COLUMNS = """
inventory_snapshot_id snapshot_date store_id store_name store_city store_region store_format product_id product_name
category subcategory stock_on_hand reorder_point reorder_quantity is_stockout is_below_reorder_point
""".split()
_PROMOTION_COLUMNS = "promotion_id promotion_name product_id discount_pct start_date end_date promotion_channel".split()
_ATTRIBUTED_COLUMNS = """
order_item_id order_id customer_id store_id order_channel order_date quantity gross_amount discount_amount net_amount
estimated_margin_amount
""".split()

# Products and stores by their key, for lines and snapshots that may lack one.
LAYERS["int_order_revenue"] = f"""
select {', '.join(_REVENUE_COLUMNS)}, cost as estimated_cost_amount, net_amount - cost as estimated_margin_amount
from (
    select *, quantity * cost_price as cost
    from (select order_item_id, order_id, product_id, line_number, quantity, unit_price, gross_amount, discount_amount,
                 net_amount, tax_amount from stg_order_items)
    join (select order_id, customer_id, store_id, status, channel, order_timestamp, order_date, currency
          from stg_orders) using (order_id)
    left join (select product_id, category, subcategory, brand, cost_price from stg_products) using (product_id))
"""
LAYERS["int_inventory_position"] = f"""
select {', '.join(_POSITION_COLUMNS)}, stock_on_hand * unit_price as stock_retail_value,
       stock_on_hand * cost_price as stock_cost_value
from stg_inventory_snapshots
left join (select store_id, store_name, city as store_city, region as store_region, store_format
           from stg_stores) using (store_id)
left join (select product_id, product_name, category, subcategory, unit_price, cost_price
           from stg_products) using (product_id)
"""
# Each line with the promotions it falls under, then the promotions that no line falls under.
LAYERS["offered"] = "select * rename (channel as promotion_channel) from stg_promotions"
LAYERS["attributed_lines"] = f"""
select {', '.join(_PROMOTION_COLUMNS + _ATTRIBUTED_COLUMNS)}
from offered join (select * rename (channel as order_channel) from int_order_revenue) using (product_id)
where promotion_channel in ('all', order_channel) and start_date <= order_date and order_date <= end_date
"""
LAYERS["int_promotion_attribution"] = f"""
select * from attributed_lines
union all by name
select {', '.join(_PROMOTION_COLUMNS)} from offered
where promotion_id not in (select promotion_id from attributed_lines)
"""
LAYERS["dim_customer"] = f"select {_key('customer_id')} as customer_key, * from stg_customers"
LAYERS["dim_product"] = f"select {_key('product_id')} as product_key, * from stg_products"
LAYERS["dim_stores"] = f"select {_key('store_id')} as store_key, * from stg_stores"
LAYERS["fct_sales"] = (
    f"select {_key('order_item_id')} as sales_key, * exclude (cost_price) from int_order_revenue"
)
LAYERS["fct_inventory_snapshot"] = (
    f"select {_key('inventory_snapshot_id')} as inventory_snapshot_key, * "
    "from int_inventory_position"
)


def _sum(column: str) -> str:
    return f"cast(sum(cast({column} as decimal(28,6))) as double)"


LAYERS["mart_daily_retail_kpis"] = f"""
select order_date, channel,
       count(distinct order_id) as total_orders,
       count(distinct customer_id) as unique_customers,
       count(distinct product_id) as unique_products_sold,
       cast(sum(quantity) as bigint) as total_units_sold,
       {_sum('gross_amount')} as gross_revenue,
       {_sum('discount_amount')} as total_discount_amount,
       {_sum('net_amount')} as net_revenue,
       {_sum('tax_amount')} as total_tax_amount,
       {_sum('estimated_cost_amount')} as total_estimated_cost_amount,
       {_sum('estimated_margin_amount')} as total_estimated_margin_amount,
       case when {_sum('net_amount')} = 0 then 0
            else {_sum('estimated_margin_amount')} / {_sum('net_amount')}
            end as estimated_margin_rate,
       {_sum('net_amount')} / count(net_amount) as avg_net_revenue
from fct_sales
group by order_date, channel
"""
LAYERS["mart_promotion_performance"] = f"""
select promotion_id, promotion_name, product_id, discount_pct, start_date, end_date,
       promotion_channel,
       count(distinct order_id) as promotion_attributed_orders,
       cast(sum(quantity) as bigint) as promotion_attributed_orders_sold,
       {_sum('gross_amount')} as promotion_attributed_gross_revenue,
       {_sum('discount_amount')} as promotion_attributed_discount_amount,
       {_sum('net_amount')} as promotion_attributed_net_revenue,
       {_sum('estimated_margin_amount')} as promotion_attributed_margin_amount
from int_promotion_attribution
group by all
"""

def expand(text: str) -> str:
    """Prefix a text with the layers it uses, each after those it uses itself."""
    ordered: list[str] = []

    def visit(part: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_]+\b", part)):
            if word in LAYERS and word not in ordered:
                visit(LAYERS[word])
                ordered.append(word)

    visit(text)
    if not ordered:
        return text
    # Parts common to several layers are computed once.
    layers = ",\n".join(f"{name} as materialized ({LAYERS[name]})" for name in ordered)
    return f"with {layers}\n{text}"


def _values(values) -> str:
    return ", ".join(_text(v) for v in values)


def _breaks(rule: Rule) -> str:
    c = rule.column
    if rule.name == "not_null":
        return f"{c} is null"
    if rule.name == "min_value":
        return f"coalesce({c} < {rule.argument}, false)"
    if rule.name == "accepted_values":
        return f"({c} is not null and {c} not in ({_values(rule.argument)}))"
    return f"({c} is not null and not regexp_matches({c}, {_text(rule.argument)}))"


def _details(rule: Rule) -> str:
    if rule.name == "min_value":
        return f"Minimum value check: >= {rule.argument}"
    if rule.name == "accepted_values":
        return f"Accepted values: {list(rule.argument)}"
    if rule.name == "regex":
        return f"Regex pattern: {rule.argument}"
    return {"not_null": "Null check", "unique": "Uniqueness check"}[rule.name]


def _duplicates(layer: str, column: str) -> str:
    return (
        f"select {column}, count(*) as n from {layer} where {column} is not null "
        f"group by {column} having count(*) > 1"
    )


def _report_line(layer: str, table: str, rule: Rule) -> str:
    if rule.name == "unique":
        failed = f"(select coalesce(sum(n), 0) from ({_duplicates(layer, rule.column)}))"
    else:
        failed = f"(select count(*) from {layer} where {_breaks(rule)})"
    return (
        f"select {_text(table)} as table_name, {_text(rule.column)} as column_name, "
        f"{_text(rule.name)} as rule_name, {failed} = 0 as passed, "
        f"cast({failed} as bigint) as failed_count, "
        f"(select count(*) from {layer}) as total_count, {_text(_details(rule))} as details"
    )


def _report(layer: str, names=None, entities=None) -> str:
    return "\nunion all ".join(
        _report_line(f"{layer}_{c.table}", c.table, rule)
        for c in CONTRACTS.values()
        for rule in c.rules
        if (names is None or rule.name in names) and (entities is None or c.table in entities)
    )


def _failed(entity: str, rule: Rule) -> str:
    if rule.column not in _columns(entity):
        return f"select * from typed_{entity}"
    if rule.name == "unique":
        inner = _duplicates(f"typed_{entity}", rule.column)
        return (
            f"select * from typed_{entity} where {rule.column} in "
            f"(select {rule.column} from ({inner}))"
        )
    return f"select * from typed_{entity} where {_breaks(rule)}"


def _quarantine(entity: str) -> str:
    return "\nunion all ".join(
        f"select *, {_text(entity)} as _quarantine_table_name, "
        f"{_text(rule.column)} as _quarantine_column_name, "
        f"{_text(rule.name)} as _quarantine_rule_name, "
        f"{_text(_details(rule))} as _quarantine_failure_reason from ({_failed(entity, rule)})"
        for rule in CONTRACTS[entity].rules
    )


def _quarantine_summary(entities=tuple(CONTRACTS)) -> str:
    lines = [
        f"select {_text(c.table)} as table_name, {_text(rule.name)} as rule_name, "
        f"{_text(rule.column)} as column_name, count(*) as row_count "
        f"from ({_failed(c.table, rule)}) having count(*) > 0"
        for c in CONTRACTS.values()
        if c.table in entities
        for rule in c.rules
    ]
    return "\nunion all ".join(lines)


def _offending(entities) -> str:
    """Values that broke a rule, a row each."""
    return "\nunion all ".join(
        f"select {_text(e)} as table_name, {_text(rule.name)} as rule_name, {_text(rule.column)} as column_name, "
        f"{f'cast({rule.column} as varchar)' if rule.column in _columns(e) else 'null'} as value from ({_failed(e, rule)})"
        for e in entities
        for rule in CONTRACTS[e].rules
    )


def _relationships() -> str:
    lines = []
    for r in RELATIONSHIPS:
        child = (
            f"(select distinct {r.child_column} as k from silver_{r.child_table} "
            f"where {r.child_column} is not null)"
        )
        parent = f"(select {r.parent_column} from silver_{r.parent_table} where {r.parent_column} is not null)"
        orphans = f"(select count(*) from {child} where k not in {parent})"
        lines.append(
            f"select {_text(r.name)} as table_relationship_name, "
            f"{_text(r.child_table)} as child_table, {_text(r.child_column)} as child_column, "
            f"{_text(r.parent_table)} as parent_table, {_text(r.parent_column)} as parent_column, "
            f"{orphans} = 0 as passed, {orphans} as failed_count, "
            f"(select count(*) from {child}) as child_count, "
            f"{_text(f'{r.child_table}.{r.child_column} must exist in {r.parent_table}.{r.parent_column}')} as details"
        )
    return "\nunion all ".join(lines)


def _model_test(test) -> str:
    layer, c = test.model, test.column
    if test.name == "unique":
        unit, found = "keys", f"select count(*) from ({_duplicates(layer, c)})"
    elif test.name == "accepted_values":
        unit, found = "values", (
            f"select count(distinct {c}) from {layer} where {c} not in ({_values(test.argument)})"
        )
    elif test.name == "relationships":
        parent, column = test.argument
        unit, found = "rows", (
            f"select count(*) from {layer} where {c} is not null and {c} not in "
            f"(select {column} from {parent} where {column} is not null)"
        )
    else:
        unit, found = "rows", f"select count(*) from {layer} where {_breaks(test.rule)}"
    return (
        f"select {_text(test.model)} as model_name, {_text(c)} as column_name, "
        f"{_text(test.name)} as test_name, {_text(unit)} as unit, ({found}) as failures, "
        f"({found}) = 0 as passed"
    )


def _model_tests(name: str | None) -> str:
    return "\nunion all ".join(
        _model_test(t) for t in MODEL_TESTS if name is None or t.name == name
    )


def _typed(entity: str, replaced: dict[str, str]) -> str:
    return ", ".join(
        f"{replaced.get(c, f'try_cast({c} as {_SQL_TYPES[k]})')} as {c}"
        for c, k in ENTITIES[entity].columns
    )


def _event_breaks() -> dict[str, str]:
    return {
        "not_null:event_type": "event_type is null",
        "accepted_values:event_type": "event_type not in ('view', 'click', 'purchase', 'signup')",
        "min_value:value": "value < 1.0",
        "regex:props": "not regexp_matches(props, '^\\{.*\\}$')",
    }


def _graded() -> str:
    return f"""
    select *,
           case when column_name = 'last_name' then 'warn' else 'error' end as severity,
           case when total_count > 0 then failed_count / total_count else 0.0 end as failed_ratio,
           case when passed then 'pass'
                when column_name = 'loyalty_tier' and failed_count / total_count <= 0.05 then 'pass'
                when column_name = 'last_name' then 'warn'
                else 'fail' end as status
    from ({_report('silver', entities=['customers'])})
    """


def _landed(entity: str) -> str:
    """Silver of an entity that was CSV on the way: empty text is NULL there."""
    texts = [f"nullif({c}, '') as {c}" for c, k in ENTITIES[entity].columns if k == "string"]
    return f"select * replace ({', '.join(texts)}) from silver_{entity}"


def all_oracles() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["conform_orders"] = "select {} from raw_orders".format(
        _typed(
            "orders",
            {
                "gross_amount": "case when order_id like '%07' then null "
                "else cast(gross_amount as double) end",
                "source_file_date": "case when order_id like '%13' then null "
                "else source_file_date end",
                "created_by_system": "cast(null as varchar)",
            },
        )
    )
    sql["conform_order_items"] = "select {} from raw_order_items".format(
        _typed("order_items", {"quantity": "case when quantity = 7 then null else quantity end"})
    )
    line = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    rest = [c for c in line if c not in ("l_orderkey", "l_linenumber", "l_shipdate")]
    sql["dedup_latest"] = (
        f"select {', '.join(line)} from (select *, row_number() over (partition by l_orderkey, "
        f"l_linenumber order by l_shipdate desc nulls last, "
        f"{', '.join(f'{c} desc nulls last' for c in rest)}) as rn from lineitem) where rn = 1"
    )
    sql["dedup_any"] = "select * from silver_order_items"
    for entity in ENTITIES:
        sql[f"silver_{entity}"] = f"select * from silver_{entity}"
        sql[f"stg_{entity}"] = f"select * from stg_{entity}"
    for name in ("not_null", "unique", "min_value", "accepted_values", "regex"):
        sql[f"rule_{name}"] = _report("typed", [name])
    sql["rule_missing_column"] = """
        select 'orders' as table_name, c as column_name, r as rule_name, passed,
               case when passed then 0 else n end as failed_count, n as total_count,
               case when passed then 'Null check'
                    else 'Column does not exist: delivery_slot' end as details
        from (values ('delivery_slot', 'not_null', false), ('delivery_slot', 'unique', false),
                     ('order_id', 'not_null', true)) as checks(c, r, passed),
             (select count(*) as n from silver_orders)
    """
    sql["validate_orders"] = _report("silver", entities=["orders"])
    sql["validation_report"] = _report("silver")
    sql["relationship_report"] = _relationships()
    sql["quality_gate"] = (
        "select 'column_checks' as check_kind, count(*) as checks, "
        f"count(*) filter (not passed) as failed_checks from ({_report('silver')}) union all "
        "select 'relationship_checks', count(*), count(*) filter (not passed) "
        f"from ({_relationships()})"
    )
    sql["orphan_keys"] = (
        "select distinct customer_id as child_key from silver_orders where customer_id is not null "
        "and customer_id not in (select customer_id from silver_customers)"
    )
    for key, (entity, rule) in FAILED_ROWS.items():
        sql[key] = _failed(entity, rule)
    for entity in ENTITIES:
        sql[f"pipeline_silver_{entity}"] = _landed(entity)
        sql[f"quarantine_{entity}"] = _quarantine(entity)
    sql["quarantine_summary"] = _quarantine_summary()
    sql["quarantine_sink"] = (
        f"select * from ({_quarantine_summary(['orders'])}) where column_name <> 'currency' or rule_name <> 'not_null'"
    )
    sql["surrogate_key"] = (
        f"select order_id, {_key('order_id', 'store_id', 'channel')} as order_key from typed_orders"
    )
    for model in ("int_order_revenue", "int_inventory_position", "int_promotion_attribution",
                  "dim_customer", "dim_product", "dim_stores", "fct_sales",
                  "fct_inventory_snapshot", "mart_daily_retail_kpis",
                  "mart_promotion_performance"):
        sql[model] = f"select * from {model}"
    sql["line_amount_mismatch"] = """
        select * from (
            select order_item_id,
                   abs(net_amount - (gross_amount - discount_amount)) > 0.005 as net_is_off,
                   abs(gross_amount - round(unit_price * quantity, 2)) > 0.005 as gross_is_off
            from silver_order_items)
        where net_is_off or gross_is_off
    """
    sql["inventory_flag_mismatch"] = """
        select * from (
            select inventory_snapshot_id,
                   is_stockout is distinct from (stock_on_hand = 0) as stockout_is_off,
                   is_below_reorder_point is distinct from (stock_on_hand < reorder_point)
                       as below_reorder_point_is_off
            from silver_inventory_snapshots)
        where stockout_is_off or below_reorder_point_is_off
    """
    sql["promotion_active"] = """
        select promotion_id, is_active,
               coalesce(start_date <= date '1996-03-31' and end_date >= date '1996-02-01', false)
                   as is_in_period
        from silver_promotions
    """
    exact = "cast({} as decimal(28,6))".format
    # Amounts that decimal cannot hold stand apart: they differ from anything, by NULL.
    sql["order_header_reconcile"] = f"""
        select order_id, has_header, has_lines, cast(gross as double) as gross_difference,
               cast(discount as double) as discount_difference,
               cast(tax as double) as tax_difference, cast(net as double) as net_difference
        from (
            select order_id, h.order_id is not null as has_header,
                   l.order_id is not null as has_lines, order_id like '%021' or order_id like '%130' or order_id like '%239' as damaged,
                   case when order_id like '%021' or order_id like '%130' or order_id like '%239' then null
                        else {exact('h.gross_amount')} - l.gross end as gross,
                   {exact('h.discount_amount')} - l.discount as discount,
                   {exact('h.tax_amount')} - l.tax as tax,
                   {exact('h.net_amount')} - (l.gross - l.discount) as net
            from silver_orders h
            full outer join (
                select order_id, sum({exact('gross_amount')}) as gross,
                       sum({exact('discount_amount')}) as discount,
                       sum({exact('tax_amount')}) as tax
                from silver_order_items group by order_id) l using (order_id))
        where not has_header or not has_lines or (has_header and damaged) or abs(gross) > 0.005
           or abs(discount) > 0.005 or abs(tax) > 0.005 or abs(net) > 0.005
    """
    sql["csv_roundtrip"] = "select {} from raw_customers".format(
        ", ".join(f"cast({c} as varchar) as {c}" for c in _columns("customers"))
    )
    sql["bronze_lineage"] = (
        "select *, 'customers' as _bronze_source_name, "
        "'customer.parquet' as _bronze_source_file from customer"
    )
    sql["bronze_ingest_audit"] = "\nunion all ".join(
        f"select {_text(e)} as source_name, count(*) as row_count, "
        f"cast({len(_columns(e)) + 5} as integer) as column_count from raw_{e}"
        for e in ENTITIES
    )
    sql["roundtrip_reconcile"] = (
        "select count(*) as source_rows, count(*) as target_rows, true as ok from raw_orders"
    )
    sql["registered_row_counts"] = "\nunion all ".join(
        f"select {_text(e)} as table_name, count(*) as row_count from silver_{e}" for e in ENTITIES
    )
    for name in ("not_null", "unique", "accepted_values", "relationships", "regex",
                 "accepted_range"):
        sql[f"test_{name}"] = _model_tests(name)
    sql["model_test_report"] = _model_tests(None)
    sql["x_sales_breakdown"] = f"""
        select order_date, channel, store_id, category,
               grouping(order_date, channel, store_id, category) as level,
               count(*) as lines, cast(sum(quantity) as bigint) as units,
               {_sum('net_amount')} as net_revenue
        from fct_sales
        group by rollup (order_date, channel, store_id, category)
    """
    sql["x_stockout_risk"] = """
        select product_id, stock_on_hand, stores_out_of_stock, units_sold,
               stock_on_hand * days / units_sold as days_of_cover
        from (select product_id, cast(sum(stock_on_hand) as bigint) as stock_on_hand,
                     count(*) filter (is_stockout) as stores_out_of_stock
              from stg_inventory_snapshots group by product_id)
        join (select product_id, cast(sum(quantity) as bigint) as units_sold,
                     max(order_date) - min(order_date) + 1 as days
              from fct_sales group by product_id) using (product_id)
        where units_sold > 0
        order by days_of_cover, product_id
        limit 50
    """
    sql["x_funnel"] = """
        select cast(first_view as date) as cohort_date, count(*) as viewers,
               count(*) filter (exists_after) as buyers,
               count(*) filter (exists_after) / count(*) as conversion_rate
        from (select v.user_id, v.first_view,
                     exists (select 1 from events e where e.user_id = v.user_id
                             and e.event_type = 'purchase' and e.ts > v.first_view) as exists_after
              from (select user_id, min(ts) as first_view from events
                    where event_type = 'view' group by user_id) v)
        group by cast(first_view as date)
    """
    in_time = "{b}.user_id = {a}.user_id and {b}.event_type = '{kind}' and {b}.ts > {a}.ts and {b}.ts <= v.ts + interval 2 day".format
    sql["x_funnel_steps"] = f"""
        with v as (select user_id, ts from events where event_type = 'view' and user_id is not null),
        c as (select v.user_id, v.ts as began, c.ts from v join events c on {in_time(a='v', b='c', kind='click')}),
        p as (select distinct c.user_id from c join events p on p.user_id = c.user_id and p.event_type = 'purchase'
              and p.ts > c.ts and p.ts <= c.began + interval 2 day),
        n as (select count(distinct user_id) as viewers, (select count(distinct user_id) from c) as clickers,
                     (select count(*) from p) as buyers from v)
        select 0 as position, 'view' as step, viewers as users, viewers / viewers as share_of_first from n
        union all select 1, 'click', clickers, clickers / viewers from n
        union all select 2, 'purchase', buyers, buyers / viewers from n
    """
    sql["x_underperformers"] = f"""
        select store_id, store_format, net_revenue, net_revenue / average as share_of_peer_average
        from (select *, cast(sum(cast(net_revenue as decimal(28,6)))
                                 over (partition by store_format) as double)
                        / count(*) over (partition by store_format) as average
              from (select store_id, {_sum('net_amount')} as net_revenue
                    from fct_sales where store_id is not null group by store_id)
              join (select store_id, store_format from stg_stores) using (store_id))
        where net_revenue / average < 1.0
    """
    sql["x_store_rank"] = f"""
        select store_id, store_format, net_revenue, percent_rank() over (partition by store_format order by net_revenue) as peer_rank
        from (select store_id, {_sum('net_amount')} as net_revenue from fct_sales where store_id is not null group by store_id)
        join (select store_id, store_format from stg_stores) using (store_id)
        where net_revenue is not null
    """
    sql["x_product_rank"] = """
        select product_id, category, unit_price, percent_rank() over (partition by category order by unit_price) as peer_rank
        from typed_products where unit_price is not null
    """
    sql["x_quality_hotspots"] = f"""
        select table_name, count(*) as checks, count(*) filter (not passed) as failed_checks,
               cast(sum(failed_count) as bigint) as failures,
               arg_max(rule_name || ':' || column_name,
                       {{'n': failed_count, 'c': rule_name || ':' || column_name}}) as worst_check
        from ({_report('silver')})
        group by table_name
    """
    mended = f"select * from ({_offending(['orders'])}) where column_name <> 'currency' or rule_name <> 'not_null'"
    sql["x_offending_values"] = f"""
        select table_name, rule_name, column_name, value, row_count, row_count / check_rows as share
        from (select *, sum(row_count) over (partition by table_name, rule_name, column_name) as check_rows
              from (select table_name, rule_name, column_name, value, count(*) as row_count
                    from ({_offending(CONTRACTS)} union all {mended}) group by all))
        where row_count >= 0.01e0 * check_rows
    """
    weekly = f"""
        count(distinct order_id) as total_orders, count(distinct customer_id) as unique_customers,
        count(distinct product_id) as unique_products_sold, count(*) as lines,
        cast(sum(quantity) as bigint) as total_units_sold, {_sum('net_amount')} as net_revenue
    """
    sql["x_kpi_rollup"] = f"""
        select cast(date_trunc('week', order_date) as date) as period_start, channel, {weekly} from fct_sales group by 1, 2
        union all
        select cast(date_trunc('week', order_date) as date), 'all', {weekly} from fct_sales group by 1
    """
    for dim in ("dim_customer", "dim_product", "dim_stores"):
        sql[f"saved_{dim}"] = f"select * from {dim}"
    for entity in ("customers", "products", "stores"):
        sql[f"viewed_stg_{entity}"] = f"select * from stg_{entity}"
    sql["x_upsert"] = """
        select * replace (case when status = 'returned' then 'refunded' else customer_note end
                          as customer_note)
        from silver_orders
        union all
        select * replace (order_id || '-R' as order_id) from silver_orders where status = 'returned'
    """
    sql["x_partition_overwrite"] = """
        select channel, count(*) as orders, count(*) filter (channel = 'store') as redelivered
        from silver_orders group by channel
    """
    sql["x_schema_drift"] = """
        select c as column_name, issue, expected_type, found_type, (select count(*) from raw_orders) as rows
        from (values ('currency', 'missing', 'string', null), ('gift_wrap', 'unexpected', null, 'boolean'),
                     ('customer_id', 'type', 'string', 'int')) as d(c, issue, expected_type, found_type)
    """
    sql["stored_models"] = """
        select 'dim_customer' as model, count(*) as saved_rows, count(*) as view_rows from silver_customers
        union all select 'dim_product', count(*), count(*) from silver_products
        union all select 'dim_stores', count(*), count(*) from silver_stores
    """
    orders_break = " or ".join(
        _breaks(r) for r in CONTRACTS["orders"].rules if r.name != "unique"
    )
    sql["x_split_clean"] = f"select * from typed_orders where not ({orders_break})"
    sql["x_graded_report"] = _graded()
    sql["x_freshness"] = """
        select (epoch_us(timestamp '2024-01-31') - epoch_us(max(ts))) / 3600000000 as age_hours,
               (epoch_us(timestamp '2024-01-31') - epoch_us(max(ts))) / 3600000000 <= 24 as is_fresh
        from events
    """
    reason = _text("orders.customer_id must exist in customers.customer_id")
    sql["x_orphan_rows"] = f"""
        select *, 'orders' as _quarantine_table_name, 'customer_id' as _quarantine_column_name,
               'relationship' as _quarantine_rule_name, {reason} as _quarantine_failure_reason
        from silver_orders
        where customer_id is not null
          and customer_id not in (select customer_id from silver_customers)
    """
    sql["x_stream_ingest"] = (
        "select *, 'events' as _bronze_source_name, 'events.parquet' as _bronze_source_file "
        "from events"
    )
    sql["x_stream_dedup"] = "select event_id, user_id, event_type, value from events"
    sql["x_stream_volume"] = """
        select cast(date_trunc('day', ts) as date) as day, event_type, count(*) as rows
        from events
        where date_trunc('day', ts) + interval 1 day
              <= (select date_trunc('milliseconds', max(ts)) - interval 1 hour from events)
        group by 1, 2
    """
    broken = _event_breaks()
    listed = ", ".join(f"case when {test} then {_text(name)} end" for name, test in broken.items())
    sql["x_stream_validate"] = (
        f"select event_id, concat_ws(',', {listed}) as broken_rules from events "
        f"where {' or '.join(broken.values())}"
    )
    sql["x_incremental_silver"] = f"""
        select * replace (case when status = 'returned' then 'refunded' else customer_note end as customer_note,
                          case when status = 'returned' then order_timestamp + interval 1 day
                               else order_timestamp end as order_timestamp)
        from ({_landed('orders')})
    """
    number = "cast(right(store_id, 4) as integer) % 10"
    sql["bronze_bad_rows"] = f"""
        select store_id, case {number} when 3 then 'surplus_fields' when 6 then 'missing_fields'
                                       when 9 then 'open_quote' else 'good' end as reason
        from raw_stores
        where {number} <> 9 or store_id = (select min(store_id) from raw_stores where {number} = 9)
    """
    first, second = "ts < timestamp '2024-01-11'", "ts >= timestamp '2024-01-11' and ts < timestamp '2024-01-21'"
    behind = "(select max(ts) - interval 2 day from {})".format
    sql["x_stream_late"] = f"""
        with d1 as (select * from events where {first} and event_id % 10 <> 3),
        d2 as (select *, {second} as is_new from events where ({second}) or ({first} and event_id % 10 <> 3 and event_id % 7 = 0)),
        d3 as (select *, ts >= timestamp '2024-01-21' or ({first}) as is_new from events
               where ts >= timestamp '2024-01-21' or ({first} and event_id % 10 = 3) or ({second} and event_id % 7 = 1)),
        rows as (select event_id, ts, true as is_new, null::timestamp as mark from d1
                 union all select event_id, ts, is_new, {behind('d1')} from d2
                 union all select event_id, ts, is_new, {behind('d2')} from d3)
        select event_id, case when ts < mark then 'late' when is_new then 'passed' else 'duplicate' end as outcome,
               case when ts < mark then (epoch_us(mark) - epoch_us(ts)) / 1e6 end as lateness_seconds
        from rows
    """
    sql["x_stream_unique"] = """
        select event_id, user_id, event_type, day
        from (select *, cast(ts as date) as day from events)
        qualify count(*) over (partition by user_id, event_type, day) > 1
    """
    sql["x_stream_orphans"] = """
        with children as (select event_id, user_id, ts, event_id - event_id % 4 as opened_by from events
                          where event_id % 4 <> 0 and event_type = 'purchase'),
        parents as (select event_id, ts from events where event_id % 4 = 0 and event_type <> 'signup')
        select event_id, user_id, opened_by from children
        where opened_by not in (select event_id from parents)
          and ts + interval 5 day <= date_trunc('milliseconds', least((select max(ts) from children), (select max(ts) from parents)) - interval 1 day)
    """
    return {key: expand(text) for key, text in sql.items()}
