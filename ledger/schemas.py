"""The four tables: ordered fields, types, keys, allowed values and declared constraints."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

# Field order is the exact header of every file of the table.
FIELDS: dict[str, list[tuple[str, T.DataType]]] = {
    "customers": [
        ("customer_id", T.LongType()),
        ("customer_name", T.StringType()),
        ("email", T.StringType()),
        ("city", T.StringType()),
        ("state", T.StringType()),
        ("created_at", T.TimestampType()),
        ("updated_at", T.TimestampType()),
    ],
    "products": [
        ("product_id", T.LongType()),
        ("product_name", T.StringType()),
        ("category", T.StringType()),
        ("brand", T.StringType()),
        ("unit_price", MONEY),
        ("created_at", T.TimestampType()),
        ("updated_at", T.TimestampType()),
    ],
    "orders": [
        ("order_id", T.LongType()),
        ("customer_id", T.LongType()),
        ("product_id", T.LongType()),
        ("quantity", T.IntegerType()),
        ("unit_price", MONEY),
        ("order_status", T.StringType()),
        ("created_at", T.TimestampType()),
        ("updated_at", T.TimestampType()),
    ],
    "payments": [
        ("payment_id", T.LongType()),
        ("order_id", T.LongType()),
        ("payment_amount", MONEY),
        ("payment_method", T.StringType()),
        ("payment_status", T.StringType()),
        ("payment_time", T.TimestampType()),
        ("updated_at", T.TimestampType()),
    ],
}

TABLES = list(FIELDS)
KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "payments": "payment_id",
}

# Fixed values.
ORDER_STATUSES = ["completed", "pending", "cancelled", "returned"]
PAYMENT_METHODS = ["UPI", "Card", "Net Banking", "COD"]
PAYMENT_STATUSES = ["successful", "failed", "pending", "refunded"]

# Declared limits.
MAX_LENGTHS = {
    "customers": {"customer_name": 120, "email": 255, "city": 80, "state": 80},
    "products": {"product_name": 180, "category": 60, "brand": 60},
    "orders": {"order_status": 20},
    "payments": {"payment_method": 20, "payment_status": 20},
}
NULLABLE = {"orders": {"customer_id", "product_id"}}
UNIQUE = {"customers": ["email"], "products": ["product_name"]}
REFERENCES = {
    "orders": [("customer_id", "customers"), ("product_id", "products")],
    "payments": [("order_id", "orders")],
}


def columns(table: str) -> list[str]:
    return [name for name, _ in FIELDS[table]]


def typed_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in FIELDS[table]])


def text_schema(table: str, *extra: str) -> T.StructType:
    return T.StructType(
        [T.StructField(name, T.StringType()) for name in [*columns(table), *extra]]
    )


def timestamps(table: str) -> list[str]:
    return [n for n, kind in FIELDS[table] if isinstance(kind, T.TimestampType)]
