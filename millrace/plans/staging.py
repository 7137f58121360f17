"""Column specs of the staged tables.

Each entry reads ``target: kind`` or ``target: kind < source column``. Kinds:
bigint, int, boolean, decimal(p,s), date and timestamp are strict casts, the same
with ``try`` are safe casts, ``text`` and ``category`` are cleaned strings and
``string`` is taken as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import cleaning

# Names and types of the staged columns.
STAGED = {
    "customers": {
        "customer_id": "bigint",
        "full_name": "text",
        "email": "text",
        "phone": "text",
        "created_at": "try timestamp",
    },
    "customer_addresses": {
        "address_id": "bigint",
        "customer_id": "bigint",
        "label": "category",
        "line_1": "text",
        "line_2": "text",
        "city": "text",
        "state": "text",
        "country": "text",
        "postal_code": "text",
        "latitude": "decimal(9,6)",
        "longitude": "decimal(9,6)",
        "is_default": "boolean",
        "created_at": "try timestamp",
    },
    "restaurant_brands": {
        "brand_id": "bigint",
        "brand_name": "text",
        "is_active": "boolean",
        "created_at": "try timestamp",
    },
    "restaurant_outlets": {
        "restaurant_id": "bigint",
        "brand_id": "bigint",
        "outlet_name": "text",
        "city": "text",
        "delivery_zone": "text",
        "address_line1": "text",
        "postal_code": "text",
        "is_active": "boolean",
        "created_at": "try timestamp",
    },
    "menu_items": {
        "menu_item_id": "bigint",
        "restaurant_id": "bigint",
        "item_name": "text",
        "category": "text",
        "price_amount": "decimal(10,2) < price",
        "is_available": "boolean",
        "created_at": "try timestamp",
    },
    "couriers": {
        "courier_id": "bigint",
        "city": "text",
        "vehicle": "category",
        "is_active": "boolean",
        "created_at": "try timestamp",
    },
    "currencies": {
        "currency_id": "bigint",
        "currency_code": "category",
        "currency_name": "text",
        "is_active": "boolean",
        "created_at": "try timestamp",
    },
    "fx_rates": {
        "fx_rate_id": "try bigint",
        "base_currency_id": "try bigint",
        "quote_currency_id": "try bigint",
        "rate_ts": "try timestamp",
        "rate": "try decimal(18,8)",
        "source": "string",
        "rate_date_utc": "date < rate_day",
    },
    "orders": {
        "order_id": "bigint",
        "customer_id": "bigint",
        "delivery_address_id": "bigint",
        "restaurant_id": "bigint",
        "order_placed_at": "timestamp",
        "scheduled_delivery_at": "timestamp < scheduled_delivery",
        "subtotal": "decimal(12,2)",
        "tax": "decimal(12,2)",
        "delivery_fee": "decimal(12,2)",
        "discount": "decimal(12,2)",
        "total_amount": "decimal(12,2)",
        "payment_method": "category",
        "payment_status": "category",
        "currency_id": "bigint",
        "order_date_utc": "date < order_day",
    },
    "order_items": {
        "order_item_id": "bigint",
        "order_id": "bigint",
        "menu_item_id": "bigint",
        "quantity": "int",
        "unit_price": "decimal(10,2)",
        "line_total": "decimal(12,2)",
        "order_date_utc": "date < order_day",
    },
    "order_status_events": {
        "event_id": "try bigint",
        "order_id": "try bigint",
        "event_ts": "try timestamp",
        "status": "category",
        "actor": "category",
        "notes": "text",
        "event_date_utc": "date < event_day",
    },
    "delivery_assignments": {
        "order_id": "bigint",
        "courier_id": "bigint",
        "assigned_at": "try timestamp",
        "pickup_eta": "try timestamp",
        "dropoff_eta": "try timestamp",
    },
    "refunds": {
        "refund_id": "try bigint",
        "order_id": "try bigint",
        "refund_ts": "try timestamp",
        "refund_reason": "category",
        "refund_amount": "try decimal(12,2)",
        "currency_id": "try bigint",
        "refund_date_utc": "date < refund_day",
    },
    "ratings": {
        "rating_id": "bigint",
        "order_id": "bigint",
        "customer_id": "bigint",
        "restaurant_rating": "int",
        "courier_rating": "int",
        "comment": "text",
        "created_at": "try timestamp",
    },
}

# Event time and partition column of the tables exported by day.
# Order lines take the day of their order.
DAY_COLUMNS = {
    "orders": ("order_placed_at", "order_day"),
    "order_items": ("order_placed_at", "order_day"),
    "order_status_events": ("event_ts", "event_day"),
    "refunds": ("refund_ts", "refund_day"),
    "fx_rates": ("rate_ts", "rate_day"),
}


def source_of(target: str, kind: str) -> tuple[str, str]:
    """Kind and source column of one spec entry."""
    kind, _, source = (part.strip() for part in kind.partition("<"))
    return kind, source or target


def staged_column(target: str, entry: str, raw: DataFrame) -> Column:
    kind, source = source_of(target, entry)
    safe = kind.startswith("try ")
    dtype = kind.removeprefix("try ")
    found = raw.schema[source].dataType
    if dtype == "text":
        out = cleaning.clean_text(source)
    elif dtype == "category":
        out = cleaning.clean_category(source)
    elif dtype == "timestamp":
        out = cleaning.utc_timestamp(source, found, safe)
    elif dtype in ("int", "bigint"):
        out = cleaning.whole_number(source, found, dtype, safe)
    elif safe:
        out = cleaning.safe_cast(source, dtype)
    else:
        out = cleaning.strict_cast(source, dtype)
    return out.alias(target)


def stage(table: str, raw: DataFrame) -> DataFrame:
    """Typed and cleaned projection of a raw table; keeps every row."""
    return raw.select(*[staged_column(target, entry, raw) for target, entry in STAGED[table].items()])
