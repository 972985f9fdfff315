"""Every table job as a query over the shared test tables.

Each builder takes ``(spark, sf_dir)``, derives the source datasets from the
test tables (``sources.standins``) and returns the job's output DataFrame over
the whole tables. ``rough_*`` queries run the same jobs over stand-ins with
repeated ids, references to missing rows and NULL keys. Nothing is written except
by the bronze round trips and the catalog query, which write to a fresh folder or
database under the shared scratch root.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.operators import centroid, dedupe, money_sums, profile
from emporia.plans import gold, silver
from emporia.plans.bronze import ingest
from emporia.session import fresh_scratch_path, scratch_root
from emporia.sources import standins
from emporia.sources.landing import write_csv
from emporia.sources.registry import MULTILINE_SOURCES, SOURCE_FILES, Registry
from emporia.sources.tables import Warehouse, read_layer, write_layer

# Rows of a landed review file; buckets of the catalog query's tables.
REVIEWS_PER_FILE = 250_000
CATALOG_BUCKETS = 8

Query = Callable[[SparkSession, str], DataFrame]


class Silver:
    """Lazily built silver frames over one test-data folder; ``rough``: with repeated, missing and NULL keys."""

    def __init__(self, spark: SparkSession, sf_dir: str, rough: bool = False):
        self.spark, self.sf_dir = spark, sf_dir
        self.build = standins.rough if rough else standins.source

    def src(self, name: str) -> DataFrame:
        return self.build(self.spark, self.sf_dir, name)

    def customers(self) -> DataFrame:
        return silver.customers(self.src("customers"), self.src("geolocation"))

    def sellers(self) -> DataFrame:
        return silver.sellers(self.src("sellers"), self.src("geolocation"))

    def products(self) -> DataFrame:
        return silver.products(self.src("products"), self.src("product_category_translation"))

    def orders(self) -> DataFrame:
        return silver.orders(self.src("orders"))

    def order_items(self) -> DataFrame:
        return silver.order_items(self.src("order_items"))

    def payments(self) -> DataFrame:
        return silver.payments(self.src("order_payments"))

    def reviews(self) -> DataFrame:
        return silver.reviews(self.src("order_reviews"))


def dedupe_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key dedupe alone: one source row per (order_id, order_item_id)."""
    return dedupe(standins.order_items(spark, sf_dir), ["order_id", "order_item_id"])


def geo_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid(standins.geolocation(spark, sf_dir))


def profile_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(Silver(spark, sf_dir).order_items())


GOLD: dict[str, Callable[[Silver], DataFrame]] = {
    "sales_fact": lambda s: gold.sales_fact(s.orders(), s.order_items(), s.products(), s.customers(), s.sellers()),
    "daily_sales": lambda s: gold.daily_sales(s.orders(), s.order_items(), s.customers()),
    "customer_ltv": lambda s: gold.customer_ltv(s.orders(), s.order_items(), s.customers()),
    "product_performance": lambda s: gold.product_performance(s.order_items(), s.products(), s.reviews()),
    "review_insights": lambda s: gold.review_insights(s.reviews(), s.orders(), s.order_items(), s.products()),
}


def bronze_roundtrip(dataset: str) -> Query:
    """Land the stand-in as CSV part files, ingest it (text read, casts by name) into
    its bronze table and read that back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = standins.source(spark, sf_dir, dataset)
        root = fresh_scratch_path(spark, f"bronze-{dataset}")
        registry = Registry(landing_root=f"{root}/landing")
        # Whole-record files cannot be split: bounded part files keep their read parallel.
        bound = REVIEWS_PER_FILE if dataset in MULTILINE_SOURCES else 0
        write_csv(source, registry.source_path(dataset), max_records_per_file=bound)
        warehouse = Warehouse(registry=registry, root=f"{root}/warehouse")
        ingest(spark, dataset, warehouse, schema=source.schema)
        return read_layer(spark, dataset, "bronze", warehouse)

    run.__name__ = f"bronze_{dataset}"
    return run


def catalog_order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their item totals, over catalog tables.

    Silver orders and items are saved as tables of a fresh database under the scratch
    root, bucketed alike on the order; read back by name, they are aggregated and
    joined without a shuffle.
    """
    s = Silver(spark, sf_dir)
    database = f"emporia_{uuid.uuid4().hex}"
    warehouse = Warehouse(Registry(databases={"silver": database}), databases_under=scratch_root(spark))
    for dataset in ("orders", "order_items"):
        frame = getattr(s, dataset)()
        write_layer(frame, dataset, "silver", warehouse, bucket_by=(CATALOG_BUCKETS, "order_id"))
    orders, items = (read_layer(spark, d, "silver", warehouse) for d in ("orders", "order_items"))
    return orders.select("order_id", "customer_id").join(gold.item_totals_by_order(items), "order_id").select(
        "order_id", "customer_id", money_sums(spark).value("amount_sum").alias("amount"), F.col("amount_n").alias("items")
    )


def _silver_query(name: str, rough: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Silver(spark, sf_dir, rough), name)()

    run.__name__ = f"silver_{name}"
    return run


def _gold_query(name: str, rough: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return GOLD[name](Silver(spark, sf_dir, rough))

    run.__name__ = f"gold_{name}"
    return run


QUERIES: dict[str, Query] = {
    "dedupe_order_items": dedupe_order_items,
    "geo_centroid": geo_centroid,
    **{f"silver_{n}": _silver_query(n) for n in
       ("customers", "sellers", "products", "orders", "order_items", "payments", "reviews")},
    **{f"gold_{n}": _gold_query(n) for n in GOLD},
    "profile_order_items": profile_order_items,
    **{f"bronze_{d}": bronze_roundtrip(d) for d in SOURCE_FILES},
    "catalog_order_totals": catalog_order_totals,
    **{f"rough_silver_{n}": _silver_query(n, rough=True) for n in ("customers", "sellers", "orders")},
    **{f"rough_gold_{n}": _gold_query(n, rough=True) for n in GOLD},
}
