"""Contracts of the silver tables, their relationships, and the tests of the gold models."""

from __future__ import annotations

from shelfstrata.operators.modeltests import ModelTest
from shelfstrata.operators.rules import Contract, Relationship

# Patterns and accepted values of the data model.
CUSTOMER_ID = "^CUSTOMER-[0-9]{6}$"
STORE_ID = "^STORE-[0-9]{4}$"
PRODUCT_ID = "^PRODUCT-[0-9]{6}$"
ORDER_ID = "^ORDER-[0-9]{8}$"
ORDER_ITEM_ID = "^ORDER-[0-9]{8}-[0-9]{3}$"
PROMOTION_ID = "^PROMO-[0-9]{4}$"
EMAIL = "^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$"
LOYALTY_TIERS = ("Bronze", "Silver", "Gold", "Platinum")
STORE_FORMATS = ("convenience", "standard", "flagship", "warehouse")
CATEGORIES = ("Grocery", "Electronics", "Clothing", "Home", "Health")
CHANNELS = ("online", "store", "mobile_app")
STATUSES = ("confirmed", "fulfilled", "cancelled", "returned")
PAYMENT_METHODS = (
    "credit_card",
    "debit_card",
    "paypal",
    "gift_card",
    "apple_pay",
    "google_pay",
)
SOURCE_SYSTEMS = ("ecommerce_platform", "pos_system", "mobile_app")
CURRENCIES = ("GBP",)

_REQUIRED = ["not_null"]
_KEY = ["not_null", "unique"]


def _pattern(pattern):
    return ["not_null", {"regex": pattern}]


def _key_pattern(pattern):
    return ["not_null", "unique", {"regex": pattern}]


def _one_of(values):
    return ["not_null", {"accepted_values": list(values)}]


def _at_least(value):
    return [{"min_value": value}]


# Which rules each silver column carries.
CONTRACTS: dict[str, Contract] = {
    contract.table: contract
    for contract in (
        Contract.of(
            "customers",
            ["customer_id"],
            {
                "customer_id": _key_pattern(CUSTOMER_ID),
                "first_name": _REQUIRED,
                "last_name": _REQUIRED,
                "email": _pattern(EMAIL),
                "phone_number": _REQUIRED,
                "city": _REQUIRED,
                "region": _REQUIRED,
                "postal_code": _REQUIRED,
                "address": _REQUIRED,
                "loyalty_tier": _one_of(LOYALTY_TIERS),
                "creation_datetime": _REQUIRED,
                "is_active": _REQUIRED,
            },
        ),
        Contract.of(
            "inventory_snapshots",
            ["inventory_snapshot_id"],
            {
                "inventory_snapshot_id": _KEY,
                "store_id": _pattern(STORE_ID),
                "product_id": _pattern(PRODUCT_ID),
                "stock_on_hand": _at_least(0),
                "reorder_point": _at_least(0),
                "reorder_quantity": _at_least(1),
            },
        ),
        Contract.of(
            "orders",
            ["order_id"],
            {
                "order_id": _key_pattern(ORDER_ID),
                "customer_id": _pattern(CUSTOMER_ID),
                "channel": _one_of(CHANNELS),
                "status": _one_of(STATUSES),
                "payment_method": _one_of(PAYMENT_METHODS),
                "created_by_system": _one_of(SOURCE_SYSTEMS),
                "currency": _one_of(CURRENCIES),
                "gross_amount": _at_least(0),
                "discount_amount": _at_least(0),
                "net_amount": _at_least(0),
                "tax_amount": _at_least(0),
            },
        ),
        Contract.of(
            "order_items",
            ["order_item_id"],
            {
                "order_item_id": _key_pattern(ORDER_ITEM_ID),
                "order_id": _pattern(ORDER_ID),
                "product_id": _pattern(PRODUCT_ID),
                "line_number": _at_least(1),
                "quantity": _at_least(1),
                "unit_price": _at_least(0),
                "gross_amount": _at_least(0),
                "discount_amount": _at_least(0),
                "net_amount": _at_least(0),
                "tax_amount": _at_least(0),
            },
        ),
        Contract.of(
            "products",
            ["product_id"],
            {
                "product_id": _key_pattern(PRODUCT_ID),
                "sku": _KEY,
                "category": _one_of(CATEGORIES),
                "unit_price": _at_least(0),
                "cost_price": _at_least(0),
                "is_active": _REQUIRED,
            },
        ),
        Contract.of(
            "promotions",
            ["promotion_id"],
            {
                "promotion_id": _key_pattern(PROMOTION_ID),
                "product_id": _pattern(PRODUCT_ID),
                "discount_pct": _at_least(1),
                "channel": _one_of(CHANNELS),
            },
        ),
        Contract.of(
            "stores",
            ["store_id"],
            {
                "store_id": _key_pattern(STORE_ID),
                "store_name": _REQUIRED,
                "city": _REQUIRED,
                "region": _REQUIRED,
                "opening_date": _REQUIRED,
                "store_format": _one_of(STORE_FORMATS),
                "is_active": _REQUIRED,
                "postal_code": _REQUIRED,
            },
        ),
    )
}

# The keys that tie the silver tables together.
RELATIONSHIPS: tuple[Relationship, ...] = (
    Relationship("orders_customer_foreign_key", "orders", "customer_id", "customers", "customer_id"),
    Relationship("order_items_order_foreign_key", "order_items", "order_id", "orders", "order_id"),
    Relationship(
        "order_items_product_foreign_key", "order_items", "product_id", "products", "product_id"
    ),
    Relationship(
        "inventory_store_foreign_key", "inventory_snapshots", "store_id", "stores", "store_id"
    ),
    Relationship(
        "inventory_product_foreign_key", "inventory_snapshots", "product_id", "products", "product_id"
    ),
    Relationship(
        "promotions_product_foreign_key", "promotions", "product_id", "products", "product_id"
    ),
)


def _tests(model: str, columns: dict[str, list]) -> list[ModelTest]:
    return [
        ModelTest(model, column, *(test if isinstance(test, tuple) else (test,)))
        for column, tests in columns.items()
        for test in tests
    ]


def _matches(pattern):
    return ("regex", pattern)


def _in(values):
    return ("accepted_values", values)


def _parent(model, column):
    return ("relationships", (model, column))


_NOT_NEGATIVE = ("accepted_range", 0)

# The tests each gold model and staging model carries.
MODEL_TESTS: tuple[ModelTest, ...] = (
    *_tests(
        "stg_customers",
        {
            "customer_id": _KEY,
            "loyalty_tier": [_in(LOYALTY_TIERS)],
            "first_name": _REQUIRED,
            "last_name": _REQUIRED,
            "email": ["not_null", _matches(EMAIL)],
            "phone_number": _REQUIRED,
            "city": _REQUIRED,
            "region": _REQUIRED,
            "postal_code": _REQUIRED,
            "address": _REQUIRED,
            "creation_datetime": _REQUIRED,
            "is_active": _REQUIRED,
        },
    ),
    *_tests(
        "stg_stores",
        {
            "store_id": _KEY,
            "store_format": [_in(STORE_FORMATS)],
            "store_name": _REQUIRED,
            "city": _REQUIRED,
            "region": _REQUIRED,
            "opening_date": _REQUIRED,
            "is_active": _REQUIRED,
            "postal_code": _REQUIRED,
        },
    ),
    *_tests(
        "stg_products",
        {
            "product_id": [*_KEY, _matches(PRODUCT_ID)],
            "category": [_in(CATEGORIES)],
            "sku": _KEY,
            "unit_price": ["not_null", _NOT_NEGATIVE],
            "cost_price": ["not_null", _NOT_NEGATIVE],
            "is_active": _REQUIRED,
            "creation_datetime": _REQUIRED,
        },
    ),
    *_tests(
        "stg_orders",
        {
            "order_id": [*_KEY, _matches(ORDER_ID)],
            "customer_id": ["not_null", _parent("stg_customers", "customer_id")],
            "channel": [_in(CHANNELS)],
            "status": ["not_null", _in(STATUSES)],
            "payment_method": ["not_null", _in(PAYMENT_METHODS)],
            "created_by_system": ["not_null", _in(SOURCE_SYSTEMS)],
            "currency": ["not_null", _in(CURRENCIES)],
        },
    ),
    *_tests(
        "stg_order_items",
        {
            "order_item_id": [*_KEY, _matches(ORDER_ITEM_ID)],
            "order_id": ["not_null", _matches(ORDER_ID), _parent("stg_orders", "order_id")],
            "product_id": ["not_null", _matches(PRODUCT_ID), _parent("stg_products", "product_id")],
        },
    ),
    *_tests(
        "stg_inventory_snapshots",
        {
            "inventory_snapshot_id": _KEY,
            "store_id": ["not_null", _matches(STORE_ID), _parent("stg_stores", "store_id")],
            "product_id": ["not_null", _matches(PRODUCT_ID), _parent("stg_products", "product_id")],
        },
    ),
    *_tests(
        "stg_promotions",
        {
            "promotion_id": [*_KEY, _matches(PROMOTION_ID)],
            "product_id": ["not_null", _matches(PRODUCT_ID), _parent("stg_products", "product_id")],
            "channel": ["not_null", _in(CHANNELS)],
        },
    ),
    *_tests("dim_customer", {"customer_key": _KEY, "customer_id": _KEY}),
    *_tests("dim_product", {"product_key": _KEY, "product_id": _KEY}),
    *_tests("dim_stores", {"store_key": _KEY, "store_id": _KEY}),
    *_tests(
        "fct_sales",
        {
            "sales_key": _KEY,
            "order_item_id": _KEY,
            "customer_id": _REQUIRED,
            "product_id": _REQUIRED,
            "net_amount": _REQUIRED,
        },
    ),
    *_tests(
        "fct_inventory_snapshot",
        {"inventory_snapshot_key": _KEY, "inventory_snapshot_id": _KEY},
    ),
    *_tests(
        "mart_daily_retail_kpis",
        {"order_date": _REQUIRED, "channel": ["not_null", _in(CHANNELS)]},
    ),
    *_tests("mart_promotion_performance", {"promotion_id": _REQUIRED}),
)
