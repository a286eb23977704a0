"""Staging models: one explicit projection per silver table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfstrata.schemas import ENTITIES, SILVER_METADATA


def _staged(silver: DataFrame, columns: list) -> DataFrame:
    metadata = [c for c in SILVER_METADATA if c in silver.columns]
    return silver.select(*columns, *metadata)


def _names(entity: str) -> list[str]:
    return ENTITIES[entity].column_names


def stg_customers(customers: DataFrame) -> DataFrame:
    return _staged(customers, _names("customers"))


def stg_stores(stores: DataFrame) -> DataFrame:
    return _staged(stores, _names("stores"))


def stg_products(products: DataFrame) -> DataFrame:
    return _staged(products, _names("products"))


def stg_orders(orders: DataFrame) -> DataFrame:
    """Adds ``order_date``. The channel is taken as it is."""
    order_date = F.to_date("order_timestamp").alias("order_date")
    return _staged(orders, [*_names("orders"), order_date])


def stg_order_items(order_items: DataFrame) -> DataFrame:
    return _staged(order_items, _names("order_items"))


def stg_inventory_snapshots(inventory_snapshots: DataFrame) -> DataFrame:
    return _staged(inventory_snapshots, _names("inventory_snapshots"))


def stg_promotions(promotions: DataFrame) -> DataFrame:
    """The channel is trimmed and put in lower case."""
    columns = [
        F.lower(F.trim("channel")).alias(c) if c == "channel" else c for c in _names("promotions")
    ]
    return _staged(promotions, columns)


STAGING = {
    "customers": stg_customers,
    "stores": stg_stores,
    "products": stg_products,
    "orders": stg_orders,
    "order_items": stg_order_items,
    "inventory_snapshots": stg_inventory_snapshots,
    "promotions": stg_promotions,
}
