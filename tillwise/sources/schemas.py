"""The shop's six tables: types, keys and domains.

Unsigned 32-bit ids do not fit ``IntegerType`` and are read as ``LongType``; money
is ``DECIMAL(10,2)``; timestamps carry no zone.  Parquet and CSV cannot enforce
keys or domains, so they are listed here for the checks in ``operators.quality``.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TS, _LONG, _INT, _STR = T.TimestampNTZType(), T.LongType(), T.IntegerType(), T.StringType()
_MONEY = T.DecimalType(10, 2)


def _table(*columns: tuple) -> T.StructType:
    return T.StructType([T.StructField(c[0], c[1], len(c) > 2) for c in columns])


# A third element marks a nullable column: NULL there means "organic / direct".
SCHEMAS: dict[str, T.StructType] = {
    "products": _table(("product_id", _INT), ("created_at", _TS), ("product_name", _STR)),
    "website_sessions": _table(
        ("website_session_id", _LONG),
        ("created_at", _TS),
        ("user_id", _LONG),
        ("is_repeat_session", _INT),
        ("utm_source", _STR, None),
        ("utm_campaign", _STR, None),
        ("utm_content", _STR, None),
        ("device_type", _STR),
        ("http_referer", _STR, None),
    ),
    "website_pageviews": _table(
        ("website_pageview_id", _LONG),
        ("created_at", _TS),
        ("website_session_id", _LONG),
        ("pageview_url", _STR),
    ),
    "orders": _table(
        ("order_id", _LONG),
        ("created_at", _TS),
        ("website_session_id", _LONG),
        ("user_id", _LONG),
        ("primary_product_id", _INT),
        ("items_purchased", _INT),
        ("price_usd", _MONEY),
        ("cogs_usd", _MONEY),
    ),
    "order_items": _table(
        ("order_item_id", _LONG),
        ("created_at", _TS),
        ("order_id", _LONG),
        ("product_id", _INT),
        ("is_primary_item", _INT),
        ("price_usd", _MONEY),
        ("cogs_usd", _MONEY),
    ),
    "order_item_refunds": _table(
        ("order_item_refund_id", _INT),
        ("created_at", _TS),
        ("order_item_id", _LONG),
        ("order_id", _LONG),
        ("refund_amount_usd", _MONEY),
    ),
}

PRIMARY_KEYS: dict[str, str] = {
    "products": "product_id",
    "website_sessions": "website_session_id",
    "website_pageviews": "website_pageview_id",
    "orders": "order_id",
    "order_items": "order_item_id",
    "order_item_refunds": "order_item_refund_id",
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("website_pageviews", "website_session_id", "website_sessions", "website_session_id"),
    ("orders", "website_session_id", "website_sessions", "website_session_id"),
    ("orders", "primary_product_id", "products", "product_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_item_refunds", "order_item_id", "order_items", "order_item_id"),
    ("order_item_refunds", "order_id", "orders", "order_id"),
)

# Widest text each column may hold.
TEXT_LIMITS: dict[str, dict[str, int]] = {
    "products": {"product_name": 50},
    "website_sessions": {
        "utm_source": 25,
        "utm_campaign": 25,
        "utm_content": 25,
        "device_type": 10,
        "http_referer": 50,
    },
    "website_pageviews": {"pageview_url": 50},
}

# Columns in which the source files write the text NULL for a missing value.
NULL_TEXT_COLUMNS: dict[str, tuple[str, ...]] = {
    "website_sessions": ("utm_source", "utm_campaign", "utm_content", "http_referer"),
}
