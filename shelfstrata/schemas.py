"""Silver schemas, primary keys and recency columns of the seven retail entities."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class Entity:
    """A silver table: typed columns in order, the key rows are unique on, and
    the columns that say which of two rows with one key is the newer."""

    name: str
    columns: tuple[tuple[str, str], ...]
    key: tuple[str, ...]
    recency: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(name, _TYPES[kind], name not in self.key) for name, kind in self.columns]
        )

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]


def _entity(name: str, key: str, columns: str, recency: tuple[str, ...] = ()) -> Entity:
    pairs = tuple(tuple(item.split()) for item in columns.split(","))
    return Entity(name, pairs, (key,), recency)


# Column names, types, keys and recency columns of the data model.
CUSTOMERS = _entity(
    "customers",
    "customer_id",
    "customer_id string, first_name string, last_name string, email string, phone_number string, "
    "city string, region string, postal_code string, address string, loyalty_tier string, "
    "creation_datetime timestamp, is_active boolean",
    ("creation_datetime",),
)
STORES = _entity(
    "stores",
    "store_id",
    "store_id string, store_name string, city string, region string, postal_code string, "
    "store_format string, opening_date date, is_active boolean",
)
PRODUCTS = _entity(
    "products",
    "product_id",
    "product_id string, sku string, product_name string, category string, subcategory string, "
    "brand string, unit_price double, cost_price double, is_active boolean, "
    "creation_datetime timestamp",
    ("creation_datetime",),
)
ORDERS = _entity(
    "orders",
    "order_id",
    "order_id string, customer_id string, store_id string, channel string, status string, "
    "order_timestamp timestamp, currency string, gross_amount double, discount_amount double, "
    "net_amount double, tax_amount double, payment_method string, created_by_system string, "
    "source_file_date date, customer_note string",
    ("order_timestamp", "source_file_date"),
)
ORDER_ITEMS = _entity(
    "order_items",
    "order_item_id",
    "order_item_id string, order_id string, line_number int, product_id string, quantity int, "
    "unit_price double, gross_amount double, discount_amount double, net_amount double, "
    "tax_amount double",
)
INVENTORY_SNAPSHOTS = _entity(
    "inventory_snapshots",
    "inventory_snapshot_id",
    "inventory_snapshot_id string, store_id string, product_id string, snapshot_date date, "
    "stock_on_hand int, reorder_point int, reorder_quantity int, is_stockout boolean, "
    "is_below_reorder_point boolean",
    ("snapshot_date",),
)
PROMOTIONS = _entity(
    "promotions",
    "promotion_id",
    "promotion_id string, promotion_name string, product_id string, discount_pct int, "
    "start_date date, end_date date, channel string, is_active boolean",
    ("start_date", "end_date"),
)

ENTITIES: dict[str, Entity] = {
    entity.name: entity
    for entity in (
        CUSTOMERS,
        STORES,
        PRODUCTS,
        ORDERS,
        ORDER_ITEMS,
        INVENTORY_SNAPSHOTS,
        PROMOTIONS,
    )
}

SILVER_METADATA = ("_silver_processed_at", "_silver_processing_date")
BRONZE_METADATA = (
    "_bronze_source_name",
    "_bronze_source_file",
    "_bronze_source_path",
    "_bronze_ingested_at",
    "_bronze_ingestion_date",
)
QUARANTINE_METADATA = (
    "_quarantine_table_name",
    "_quarantine_column_name",
    "_quarantine_rule_name",
    "_quarantine_failure_reason",
    "_quarantine_time",
    "_quarantine_date",
)
