"""Declared types of the source datasets and the columns of each output table.

Source schemas are applied *by column name* after a header read, never by
position (a positional schema silently shifts values when a file has extra or
reordered columns). Columns a file has but the schema does not declare are kept
as text.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


S, I, D, TS = StringType(), IntegerType(), DoubleType(), TimestampNTZType()

# Zip prefixes and review scores stay text: zeros must survive, and a bad score
# is nulled later by a safe cast rather than failing the ingest.
SOURCE_SCHEMAS: dict[str, StructType] = {
    "customers": _schema(
        ("customer_id", S),
        ("customer_unique_id", S),
        ("customer_zip_code_prefix", S),
        ("customer_city", S),
        ("customer_state", S),
    ),
    "geolocation": _schema(
        ("geolocation_zip_code_prefix", S),
        ("geolocation_lat", D),
        ("geolocation_lng", D),
    ),
    "order_items": _schema(
        ("order_id", S),
        ("order_item_id", I),
        ("product_id", S),
        ("seller_id", S),
        ("price", D),
        ("freight_value", D),
    ),
    "order_payments": _schema(
        ("order_id", S),
        ("payment_type", S),
        ("payment_value", D),
        ("payment_installments", I),
    ),
    "order_reviews": _schema(
        ("review_id", S),
        ("order_id", S),
        ("review_score", S),
        ("review_comment_message", S),
    ),
    "orders": _schema(
        ("order_id", S),
        ("customer_id", S),
        ("order_status", S),
        ("order_purchase_timestamp", TS),
        ("order_delivered_customer_date", TS),
    ),
    "products": _schema(
        ("product_id", S),
        ("product_category_name", S),
        ("product_weight_g", I),
        ("product_length_cm", I),
        ("product_height_cm", I),
        ("product_width_cm", I),
    ),
    "sellers": _schema(
        ("seller_id", S),
        ("seller_zip_code_prefix", S),
        ("seller_city", S),
        ("seller_state", S),
    ),
    "product_category_translation": _schema(
        ("product_category_name", S),
        ("product_category_name_english", S),
    ),
}

# Output columns of every silver and gold table, in order.
SILVER_COLUMNS: dict[str, list[str]] = {
    "customers": ["customer_id", "customer_unique_id", "city", "state", "latitude", "longitude"],
    "sellers": ["seller_id", "city", "state", "latitude", "longitude"],
    "products": [
        "product_id",
        "category",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ],
    "orders": [
        "order_id",
        "customer_id",
        "order_created_ts",
        "order_delivered_ts",
        "order_status",
        "delivery_days",
        "is_delivered",
    ],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"],
    "payments": ["order_id", "payment_type", "payment_value", "payment_installments"],
    "reviews": ["review_id", "order_id", "review_score", "review_text"],
}

GOLD_COLUMNS: dict[str, list[str]] = {
    "sales_fact": [
        "order_id",
        "order_timestamp",
        "customer_id",
        "seller_id",
        "product_id",
        "category",
        "price",
        "freight_value",
        "total_amount",
        "customer_city",
        "customer_state",
        "seller_city",
        "seller_state",
    ],
    "daily_sales": ["order_date", "customer_state", "total_orders", "total_revenue", "avg_order_value"],
    "customer_ltv": [
        "customer_id",
        "customer_state",
        "total_orders",
        "total_spent",
        "last_order_timestamp",
    ],
    "product_performance": [
        "product_id",
        "category",
        "total_units_sold",
        "total_revenue",
        "average_review_score",
    ],
    "review_insights": ["review_id", "review_score", "review_text", "category", "order_timestamp"],
}
