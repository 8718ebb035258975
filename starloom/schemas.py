"""Fixed schemas of the staged tables and of the star schema."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Columns each raw source must have; other columns pass through untouched.
REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": (
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        "customer_zip_code_prefix",
    ),
    "orders": ("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
    "order_items": ("order_id", "order_item_id", "product_id", "price", "freight_value"),
    "products": ("product_id", "product_category_name"),
}

# Optional order time columns, parsed only when present.
ORDER_TIME_COLUMNS: tuple[str, ...] = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)

# Keys every API product record must carry (presence, not non-null).
API_REQUIRED_KEYS: tuple[str, ...] = ("id", "title", "price", "category", "rating")

DIM_DATE = _struct(
    ("date_key", I, False),
    ("full_date", S, False),
    ("year", I, False),
    ("month", I, False),
    ("day", I, False),
    ("quarter", I, False),
    ("weekday", S, False),
)

DIM_CUSTOMER = _struct(
    ("customer_key", L, False),
    ("customer_id", S, False),
    ("city", S, True),
    ("state", S, True),
    ("zip_code", S, True),
    ("updated_at", TS, True),
)

DIM_PRODUCT = _struct(
    ("product_key", L, False),
    ("product_id", S, False),
    ("category", S, True),
    ("name", S, True),
    ("api_price", D, True),
    ("api_rating", D, True),
    ("updated_at", TS, True),
)

DIM_STATUS = _struct(("status_key", L, False), ("status_label", S, False))

FACT_ORDERS = _struct(
    ("fact_id", L, False),
    ("order_id", S, False),
    ("order_item_seq", L, False),
    ("customer_key", L, True),
    ("product_key", L, True),
    ("date_key", I, True),
    ("status_key", L, True),
    ("quantity", I, False),
    ("price", D, False),
    ("freight_value", D, False),
    ("loaded_at", TS, True),
)

STAR_SCHEMAS: dict[str, T.StructType] = {
    "dim_date": DIM_DATE,
    "dim_status": DIM_STATUS,
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "fact_orders": FACT_ORDERS,
}
