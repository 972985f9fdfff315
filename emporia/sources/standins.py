"""The nine source datasets, derived from the shared test tables.

The real landing files are not available, so each source dataset is a view over
the TPC-H-like test tables (``/root/testdata/sf*/<table>.parquet``) with the
column names and meaning of the source. Everything is derived by Spark from
those tables, so the work grows with them. Keys keep their native (integer)
types; the jobs are type-agnostic about keys.

Mapping (fixed):

* orders: o_orderkey, o_custkey, o_orderdate as purchase time; status F/O/P ->
  delivered/shipped/processing; delivery time = last l_shipdate of the order
  when delivered, else NULL.
* order_items: lineitem keyed (l_orderkey, l_linenumber), which repeats, so the
  key dedupe has real work; price = l_extendedprice, freight = price * l_tax.
* customers / sellers: customer / supplier with nation as city and region as
  state; zip prefix = nation key.
* geolocation: one point per customer: zip = nation key, lat = c_acctbal,
  lng = c_custkey.
* products: part, category = p_type, weight = p_retailprice, sizes = p_size.
* product_category_translation: every p_type except PROMO, lower-cased
  (PROMO products get a NULL category).
* order_payments: one per order; payment type = priority padded with spaces.
* order_reviews: one per event; order = event_id div 2 (two reviews per order);
  score text 'n/a' for error events, else (digits of props) mod 5 + 1.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Stand-in mappings.
ORDER_STATUS = {"F": "delivered", "O": "shipped", "P": "processing"}
UNTRANSLATED_CATEGORY = "PROMO"
MISSING_SCORE = "n/a"


# Fixed-size dimensions: nation has 25 rows and region 5 at every scale factor,
# so broadcasting them is bounded regardless of data volume.
FIXED_SIZE_TABLES = frozenset({"nation", "region"})

# The test tables are read-only, so each is opened once per session (file
# listing and schema resolution happen once) and the same DataFrame is reused
# wherever a query reads it; Spark gives each use its own attributes.
_TABLES: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    opened = _TABLES.setdefault(spark, {})
    df = opened.get(path)
    if df is None:
        df = opened[path] = spark.read.parquet(path)
    return F.broadcast(df) if name in FIXED_SIZE_TABLES else df


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    last_ship = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("last_ship"))
    )
    status = F.col("o_orderstatus")
    mapped = None
    for code, label in ORDER_STATUS.items():
        mapped = (F.when(status == code, label) if mapped is None else mapped.when(status == code, label))
    return o.join(last_ship, o.o_orderkey == last_ship.l_orderkey, "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        mapped.alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.when(status == "F", F.col("last_ship")).alias("order_delivered_customer_date"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
    )


def _with_place(df: DataFrame, nation_key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return df.join(nation, df[nation_key] == nation.n_nationkey, "left").join(
        region, nation.n_regionkey == region.r_regionkey, "left"
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return _with_place(c, "c_nationkey", spark, sf_dir).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        F.col("r_name").alias("customer_state"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return _with_place(s, "s_nationkey", spark, sf_dir).select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.col("r_name").alias("seller_state"),
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
        F.col("c_acctbal").alias("geolocation_lat"),
        F.col("c_custkey").cast("double").alias("geolocation_lng"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.col("p_retailprice").alias("product_weight_g"),
        F.col("p_size").alias("product_length_cm"),
        F.col("p_size").alias("product_height_cm"),
        F.col("p_size").alias("product_width_cm"),
    )


def product_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .select(F.col("p_type").alias("product_category_name"))
        .where(F.col("product_category_name") != UNTRANSLATED_CATEGORY)
        .distinct()
        .select(
            "product_category_name",
            F.lower("product_category_name").alias("product_category_name_english"),
        )
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")).alias("payment_type"),
        F.col("o_totalprice").alias("payment_value"),
        (F.col("o_orderkey") % 12 + 1).alias("payment_installments"),
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = F.regexp_replace(F.col("props"), "[^0-9]", "").try_cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("review_id"),
        F.floor(F.col("event_id") / 2).alias("order_id"),
        F.when(F.col("event_type") == "error", F.lit(MISSING_SCORE))
        .otherwise((digits % 5 + 1).cast("string"))
        .alias("review_score"),
        F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")).alias("review_comment_message"),
    )


BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "customers": customers,
    "geolocation": geolocation,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "orders": orders,
    "products": products,
    "sellers": sellers,
    "product_category_translation": product_category_translation,
}


def _repeated(df: DataFrame, key: str, every: int, **changed: Column) -> DataFrame:
    """``df`` and once more its rows whose key is divisible by ``every``, with changed columns."""
    return df.unionByName(df.where(F.col(key) % every == 0).withColumns(changed))


def rough(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """The stand-in with the faults that raw files have, derived from the same rows.

    Customers and sellers repeat ids with other attributes; orders and products
    repeat; customers, sellers, orders and products that others refer to are
    missing; some items have no product or no freight, some reviews no order.
    """
    df = source(spark, sf_dir, dataset)
    if dataset == "customers":
        again = {
            "customer_unique_id": F.concat(F.lit("A "), F.col("customer_unique_id")),
            "customer_zip_code_prefix": (F.col("customer_zip_code_prefix") + 3) % 25,
        }
        return _repeated(df, "customer_id", 7, **again).where(F.col("customer_id") % 11 != 0)
    if dataset == "sellers":
        again = {"seller_zip_code_prefix": (F.col("seller_zip_code_prefix") + 3) % 25}
        return _repeated(df, "seller_id", 3, **again).where(F.col("seller_id") % 7 != 0)
    if dataset == "orders":
        later = F.col("order_purchase_timestamp") + F.expr("INTERVAL 1 DAY")
        return _repeated(df, "order_id", 13, order_purchase_timestamp=later).where(F.col("order_id") % 19 != 0)
    if dataset == "products":
        return _repeated(df, "product_id", 17).where(F.col("product_id") % 5 != 0)
    if dataset == "order_items":
        return df.withColumns(
            {
                "product_id": F.when(F.col("order_id") % 29 != 0, F.col("product_id")),
                "freight_value": F.when(F.col("order_item_id") != 3, F.col("freight_value")),
            }
        )
    if dataset == "order_reviews":
        return df.withColumn("order_id", F.when(F.col("review_id") % 23 != 0, F.col("order_id")))
    return df


def source(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    return BUILDERS[dataset](spark, sf_dir)
