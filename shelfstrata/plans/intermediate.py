"""Intermediate models: order lines with cost and margin, valued stock, attributed promotions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfstrata.functions.joins import interval_join

PROMOTION_COLUMNS = [
    "promotion_id",
    "promotion_name",
    "product_id",
    "discount_pct",
    "start_date",
    "end_date",
    "promotion_channel",
]
ATTRIBUTED_COLUMNS = [
    "order_item_id",
    "order_id",
    "customer_id",
    "store_id",
    "order_channel",
    "order_date",
    "quantity",
    "gross_amount",
    "discount_amount",
    "net_amount",
    "estimated_margin_amount",
]


def int_order_revenue(
    orders: DataFrame, order_items: DataFrame, products: DataFrame
) -> DataFrame:
    """Order lines with their header, product, estimated cost and margin.

    Lines without a header are left out; lines of an unknown product stay, with NULL cost.
    """
    headers = orders.select(
        "order_id",
        "customer_id",
        "store_id",
        "status",
        "channel",
        "order_timestamp",
        "order_date",
        "currency",
    )
    lines = order_items.select(
        "order_item_id",
        "order_id",
        "product_id",
        "line_number",
        "quantity",
        "unit_price",
        "gross_amount",
        "discount_amount",
        "net_amount",
        "tax_amount",
    )
    catalogue = products.select("product_id", "category", "subcategory", "brand", "cost_price")
    cost = F.col("quantity") * F.col("cost_price")
    return (
        lines.join(headers, "order_id", "inner")
        .join(catalogue, "product_id", "left")
        .select(
            "order_item_id",
            "order_id",
            "customer_id",
            "store_id",
            "status",
            "channel",
            "order_timestamp",
            "order_date",
            "currency",
            "product_id",
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
            "cost_price",
            cost.alias("estimated_cost_amount"),
            (F.col("net_amount") - cost).alias("estimated_margin_amount"),
        )
    )


def int_inventory_position(
    inventory_snapshots: DataFrame, stores: DataFrame, products: DataFrame
) -> DataFrame:
    """Stock snapshots with store and product, valued at retail and at cost price."""
    places = stores.select(
        "store_id",
        "store_name",
        F.col("city").alias("store_city"),
        F.col("region").alias("store_region"),
        "store_format",
    )
    catalogue = products.select(
        "product_id", "product_name", "category", "subcategory", "unit_price", "cost_price"
    )
    return (
        inventory_snapshots.join(places, "store_id", "left")
        .join(catalogue, "product_id", "left")
        .select(
            "inventory_snapshot_id",
            "snapshot_date",
            "store_id",
            "store_name",
            "store_city",
            "store_region",
            "store_format",
            "product_id",
            "product_name",
            "category",
            "subcategory",
            "stock_on_hand",
            "reorder_point",
            "reorder_quantity",
            "is_stockout",
            "is_below_reorder_point",
            (F.col("stock_on_hand") * F.col("unit_price")).alias("stock_retail_value"),
            (F.col("stock_on_hand") * F.col("cost_price")).alias("stock_cost_value"),
        )
    )


def _promotions(promotions: DataFrame) -> DataFrame:
    return promotions.withColumnRenamed("channel", "promotion_channel").select(*PROMOTION_COLUMNS)


def attributed_lines(
    promotions: DataFrame, order_revenue: DataFrame, days: DataFrame | None = None
) -> DataFrame:
    """Order lines with each promotion of their product, day and channel.

    A line under several promotions appears once for each of them, so amounts must not be added
    up over promotions. ``days`` may name a cheaper source of the order dates (see ``interval_join``).
    """
    lines = order_revenue.withColumnRenamed("channel", "order_channel").select(
        "product_id", *ATTRIBUTED_COLUMNS
    )
    any_channel = F.col("promotion_channel") == "all"
    same_channel = F.col("promotion_channel") == F.col("order_channel")
    matched = interval_join(
        lines,
        _promotions(promotions),
        on="product_id",
        day="order_date",
        start="start_date",
        end="end_date",
        residual=any_channel | same_channel,
        days=days,
    )
    return matched.select(*PROMOTION_COLUMNS, *ATTRIBUTED_COLUMNS)


def with_unsold(promotions: DataFrame, attributed: DataFrame) -> DataFrame:
    """Attributed lines, and every promotion that covers none of them once with NULLs.

    ``attributed`` is read twice, so large ones are best stored first. An outer join with the lines
    would have to keep all lines of a hot product in one task; here the promotions meet only the distinct ones
    among the matches.
    """
    offered = _promotions(promotions)
    sold = attributed.select(*[F.col(c).alias(f"_{c}") for c in PROMOTION_COLUMNS]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PROMOTION_COLUMNS]
    unsold = offered.join(sold, same, "left_anti")
    return attributed.unionByName(unsold, allowMissingColumns=True)


def int_promotion_attribution(
    promotions: DataFrame, order_revenue: DataFrame, days: DataFrame | None = None
) -> DataFrame:
    """Every promotion with the order lines it covers, or once with NULLs if it covers none."""
    return with_unsold(promotions, attributed_lines(promotions, order_revenue, days))
