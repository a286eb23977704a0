"""Star schema and retail marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfstrata.functions.columns import exact_sum, surrogate_key
from shelfstrata.plans.intermediate import PROMOTION_COLUMNS, _promotions, attributed_lines
from shelfstrata.schemas import ENTITIES


def _dimension(staged: DataFrame, entity: str, key: str) -> DataFrame:
    columns = ENTITIES[entity]
    return staged.select(surrogate_key(*columns.key).alias(key), *columns.column_names)


def dim_customer(customers: DataFrame) -> DataFrame:
    return _dimension(customers, "customers", "customer_key")


def dim_product(products: DataFrame) -> DataFrame:
    return _dimension(products, "products", "product_key")


def dim_stores(stores: DataFrame) -> DataFrame:
    return _dimension(stores, "stores", "store_key")


def fct_sales(order_revenue: DataFrame) -> DataFrame:
    """One row per order line."""
    return order_revenue.select(
        surrogate_key("order_item_id").alias("sales_key"),
        "order_item_id",
        "order_id",
        "customer_id",
        "store_id",
        "product_id",
        "channel",
        "status",
        "order_timestamp",
        "order_date",
        "currency",
        "category",
        "subcategory",
        "brand",
        "line_number",
        "quantity",
        "unit_price",
        "gross_amount",
        "discount_amount",
        "net_amount",
        "tax_amount",
        "estimated_cost_amount",
        "estimated_margin_amount",
    )


def fct_inventory_snapshot(inventory_position: DataFrame) -> DataFrame:
    """One row per store, product and day of the snapshot."""
    return inventory_position.select(
        surrogate_key("inventory_snapshot_id").alias("inventory_snapshot_key"), "*"
    )


#: What is counted once per day and channel.
KPI_DISTINCT = {
    "total_orders": "order_id",
    "unique_customers": "customer_id",
    "unique_products_sold": "product_id",
}


def mart_daily_retail_kpis(sales: DataFrame) -> DataFrame:
    """Orders, customers, products, units, revenue and margin per day and channel.

    All order statuses count. The margin rate is 0 where net revenue is 0; lines without a margin
    lower it. The average is per order line.

    Amounts and distinct values are aggregated apart. In one aggregate, Spark would hold a row with the state of all
    amounts for each order, customer and product of a day.
    """
    totals = sales.groupBy("order_date", "channel").agg(
        F.sum("quantity").alias("total_units_sold"),
        _amount("gross_amount").alias("gross_revenue"),
        _amount("discount_amount").alias("total_discount_amount"),
        _amount("net_amount").alias("net_revenue"),
        _amount("tax_amount").alias("total_tax_amount"),
        _amount("estimated_cost_amount").alias("total_estimated_cost_amount"),
        _amount("estimated_margin_amount").alias("total_estimated_margin_amount"),
        F.count("net_amount").alias("_priced_lines"),
    )
    values = F.array(*[F.col(c).cast("string") for c in KPI_DISTINCT.values()])
    distinct = (
        sales.select("order_date", "channel", F.posexplode(values).alias("_kind", "_value"))
        .filter("_value is not null")
        .distinct()
        .groupBy(F.col("order_date").alias("_date"), F.col("channel").alias("_channel"))
        .agg(*[F.count_if(F.col("_kind") == i).alias(name) for i, name in enumerate(KPI_DISTINCT)])
    )
    same = F.col("order_date").eqNullSafe(F.col("_date")) & F.col("channel").eqNullSafe(F.col("_channel"))
    # A day whose lines name no order, customer and product has no row among the distinct values.
    counted = [F.coalesce(name, F.lit(0)).alias(name) for name in KPI_DISTINCT]
    grouped = totals.join(distinct, same, "left").select(*totals.columns, *counted)
    net = F.col("net_revenue")
    rate = F.when(net == 0, F.lit(0.0)).otherwise(F.col("total_estimated_margin_amount") / net)
    average = F.when(F.col("_priced_lines") > 0, net / F.col("_priced_lines"))
    return grouped.select(
        "order_date",
        "channel",
        "total_orders",
        "unique_customers",
        "unique_products_sold",
        "total_units_sold",
        "gross_revenue",
        "total_discount_amount",
        "net_revenue",
        "total_tax_amount",
        "total_estimated_cost_amount",
        "total_estimated_margin_amount",
        rate.alias("estimated_margin_rate"),
        average.alias("avg_net_revenue"),
    )


def mart_promotion_performance(
    promotions: DataFrame, order_revenue: DataFrame, days: DataFrame | None = None
) -> DataFrame:
    """Attributed orders, units, revenue and margin per promotion; unsold ones with 0 and NULLs.

    ``days`` may name a cheaper source of the order dates (see ``interval_join``), such as the order headers.

    The matched lines are added up first, so that only one row per sold promotion meets the
    promotions again to bring in the unsold ones.
    """
    performance = (
        attributed_lines(promotions, order_revenue, days)
        .groupBy(*[F.col(c).alias(f"_{c}") for c in PROMOTION_COLUMNS])
        .agg(
            F.count_distinct("order_id").alias("promotion_attributed_orders"),
            F.sum("quantity").alias("promotion_attributed_orders_sold"),
            _amount("gross_amount").alias("promotion_attributed_gross_revenue"),
            _amount("discount_amount").alias("promotion_attributed_discount_amount"),
            _amount("net_amount").alias("promotion_attributed_net_revenue"),
            _amount("estimated_margin_amount").alias("promotion_attributed_margin_amount"),
        )
    )
    offered = _promotions(promotions).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PROMOTION_COLUMNS]
    return offered.join(performance, same, "left").select(
        *PROMOTION_COLUMNS,
        F.coalesce("promotion_attributed_orders", F.lit(0)).alias("promotion_attributed_orders"),
        "promotion_attributed_orders_sold",
        "promotion_attributed_gross_revenue",
        "promotion_attributed_discount_amount",
        "promotion_attributed_net_revenue",
        "promotion_attributed_margin_amount",
    )


def _amount(column: str) -> Column:
    return exact_sum(F.col(column))
