"""Silver tables: cleaned, typed, conformed versions of the bronze sources.

Each function takes bronze-shaped DataFrames and returns the silver table; no
I/O. Output columns are ``schemas.SILVER_COLUMNS``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions import (
    clean_text,
    delivery_days,
    equals_flag,
    safe_int,
    strip_spaces,
    to_double,
    wall_clock_ts,
    zip_key,
)
from emporia.operators import balanced_join, centroid, dedupe

GEO_KEY = "geolocation_zip_code_prefix"
_ZIP = "__zip_key"


def _located(df: DataFrame, zip_col: str, geolocation: DataFrame) -> DataFrame:
    """Left join to the centroid of the row's zip prefix (1:1, centroids are unique).

    A balanced join: the centroid aggregate reaches it already partitioned on the
    prefix, so only with a shuffle of its own can AQE split a prefix that holds a
    large share of the rows (a big city), or the NULL prefixes.
    """
    located = df.withColumn(_ZIP, zip_key(F.col(f"`{zip_col}`")))
    centroids = centroid(geolocation).withColumnRenamed(GEO_KEY, _ZIP)
    return balanced_join(located, centroids, _ZIP, "left")


def customers(customers: DataFrame, geolocation: DataFrame) -> DataFrame:
    """One row per customer_id with cleaned city/state and the zip centroid."""
    unique = dedupe(customers, ["customer_id"])
    return _located(unique, "customer_zip_code_prefix", geolocation).select(
        "customer_id",
        "customer_unique_id",
        clean_text(F.col("customer_city")).alias("city"),
        clean_text(F.col("customer_state")).alias("state"),
        "latitude",
        "longitude",
    )


def sellers(sellers: DataFrame, geolocation: DataFrame) -> DataFrame:
    """One row per seller_id with cleaned city/state and the zip centroid."""
    unique = dedupe(sellers, ["seller_id"])
    return _located(unique, "seller_zip_code_prefix", geolocation).select(
        "seller_id",
        clean_text(F.col("seller_city")).alias("city"),
        clean_text(F.col("seller_state")).alias("state"),
        "latitude",
        "longitude",
    )


def products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category name (NULL when untranslated).

    Not deduplicated: a repeated product_id stays repeated. The translation
    lookup is a balanced join, so a category holding a large share of the
    products (or the NULL category) is spread across tasks.
    """
    names = translation.select("product_category_name", "product_category_name_english")
    return balanced_join(products, names, "product_category_name", "left").select(
        "product_id",
        F.col("product_category_name_english").alias("category"),
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def orders(orders: DataFrame) -> DataFrame:
    """Typed order timestamps, delivery days and a delivered flag. Not deduplicated."""
    created = wall_clock_ts("order_purchase_timestamp")
    delivered = wall_clock_ts("order_delivered_customer_date")
    return orders.select(
        "order_id",
        "customer_id",
        created.alias("order_created_ts"),
        delivered.alias("order_delivered_ts"),
        "order_status",
    ).select(
        "*",
        delivery_days("order_delivered_ts", "order_created_ts").alias("delivery_days"),
        equals_flag("order_status", "delivered").alias("is_delivered"),
    )


def order_items(order_items: DataFrame) -> DataFrame:
    """One row per (order_id, order_item_id), amounts as doubles."""
    return dedupe(order_items, ["order_id", "order_item_id"]).select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        to_double("price").alias("price"),
        to_double("freight_value").alias("freight_value"),
    )


def payments(order_payments: DataFrame) -> DataFrame:
    """Normalised payment type, amount as double. Not deduplicated."""
    return order_payments.select(
        "order_id",
        clean_text("payment_type").alias("payment_type"),
        to_double("payment_value").alias("payment_value"),
        "payment_installments",
    )


def reviews(order_reviews: DataFrame) -> DataFrame:
    """Integer score (NULL when not an integer) and trimmed text. Not deduplicated."""
    return order_reviews.select(
        "review_id",
        "order_id",
        safe_int("review_score").alias("review_score"),
        strip_spaces("review_comment_message").alias("review_text"),
    )
