"""Declared schemas and fixed value lists of the commerce model."""

from __future__ import annotations

from pyspark.sql import types as T

# Wire format of a flattened change message: amounts and timestamps travel as
# strings, the delete flag as the text "true"/"false", is_active as a boolean.
_META = [
    T.StructField("__op", T.StringType()),
    T.StructField("__deleted", T.StringType()),
    T.StructField("__source_lsn", T.LongType()),
    T.StructField("__source_ts_ms", T.LongType()),
    T.StructField("__table", T.StringType()),
]

_ROWS = {
    "orders": [
        ("order_id", T.LongType()),
        ("customer_id", T.LongType()),
        ("status", T.StringType()),
        ("total_amount", T.StringType()),
        ("created_at", T.StringType()),
        ("updated_at", T.StringType()),
    ],
    "order_items": [
        ("order_item_id", T.LongType()),
        ("order_id", T.LongType()),
        ("product_id", T.LongType()),
        ("quantity", T.IntegerType()),
        ("unit_price", T.StringType()),
    ],
    "customers": [
        ("customer_id", T.LongType()),
        ("email", T.StringType()),
        ("full_name", T.StringType()),
        ("country_code", T.StringType()),
        ("created_at", T.StringType()),
        ("updated_at", T.StringType()),
    ],
    "products": [
        ("product_id", T.LongType()),
        ("sku", T.StringType()),
        ("name", T.StringType()),
        ("category", T.StringType()),
        ("price", T.StringType()),
        ("is_active", T.BooleanType()),
        ("updated_at", T.StringType()),
    ],
}

ENTITIES = tuple(_ROWS)
KEYS = {
    "orders": ["order_id"],
    "order_items": ["order_item_id"],
    "customers": ["customer_id"],
    "products": ["product_id"],
}
LOG_COLUMNS = ["op", "source_lsn", "source_ts", "is_deleted"]


def row_schema(entity: str) -> T.StructType:
    """The source row as it appears inside an envelope."""
    return T.StructType([T.StructField(n, t) for n, t in _ROWS[entity]])


def wire_schema(entity: str) -> T.StructType:
    """The flattened change message of one entity."""
    return T.StructType(row_schema(entity).fields + _META)


def envelope_schema(entity: str) -> T.StructType:
    """The un-flattened change message of one entity."""
    row = row_schema(entity)
    return T.StructType([
        T.StructField("before", row),
        T.StructField("after", row),
        T.StructField("source", T.StructType([
            T.StructField("lsn", T.LongType()),
            T.StructField("ts_ms", T.LongType()),
            T.StructField("table", T.StringType()),
        ])),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ])


# Order states and the moves between them.
STATUSES = ["pending", "paid", "shipped", "delivered", "cancelled"]
ALLOWED_TRANSITIONS = [
    ("pending", "paid"),
    ("pending", "cancelled"),
    ("paid", "shipped"),
    ("shipped", "delivered"),
]

# Outcomes of comparing one day across the three routes.
VERDICTS = ["exact", "within tolerance", "missing from warehouse", "not in source", "DIVERGED"]
