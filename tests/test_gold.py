"""Gold jobs against expected values and against brute-force row-level versions.

The brute-force versions below are the literal definitions (fan-out joins, then
plain aggregates); the library versions pre-aggregate before joining. Both must
give the same rows.
"""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from emporia.plans import gold, silver
from emporia.plans.queries import Silver
from emporia.sources import GOLD_COLUMNS, Registry, read_source
from tests.conftest import SF_SMALL, rows
from tests.fixtures import write_landing


class FixtureSilver:
    def __init__(self, spark, landing):
        reg = Registry(landing_root=landing)
        self.src = lambda name: read_source(spark, name, reg)

    def customers(self):
        return silver.customers(self.src("customers"), self.src("geolocation"))

    def sellers(self):
        return silver.sellers(self.src("sellers"), self.src("geolocation"))

    def products(self):
        return silver.products(self.src("products"), self.src("product_category_translation"))

    def orders(self):
        return silver.orders(self.src("orders"))

    def order_items(self):
        return silver.order_items(self.src("order_items"))

    def reviews(self):
        return silver.reviews(self.src("order_reviews"))


@pytest.fixture(scope="module")
def fx(spark, tmp_path_factory):
    landing = write_landing(os.path.join(str(tmp_path_factory.mktemp("gold")), "landing"))
    return FixtureSilver(spark, landing)


@pytest.fixture(scope="module")
def sf(spark):
    return Silver(spark, SF_SMALL)


# --- brute-force definitions -------------------------------------------------

def brute_daily_sales(o, i, c):
    o, i, c = o.alias("o"), i.alias("i"), c.alias("c")
    amount = F.col("i.price") + F.col("i.freight_value")
    return (
        o.join(i, F.col("o.order_id") == F.col("i.order_id"))
        .join(c, F.col("o.customer_id") == F.col("c.customer_id"))
        .groupBy(F.to_date("o.order_created_ts").alias("order_date"), F.col("c.state").alias("customer_state"))
        .agg(
            F.count_distinct("o.order_id").alias("total_orders"),
            F.sum(amount).alias("total_revenue"),
            F.avg(amount).alias("avg_order_value"),
        )
    )


def brute_customer_ltv(o, i, c):
    o, i, c = o.alias("o"), i.alias("i"), c.alias("c")
    return (
        o.join(i, F.col("o.order_id") == F.col("i.order_id"))
        .join(c, F.col("o.customer_id") == F.col("c.customer_id"))
        .groupBy(F.col("o.customer_id").alias("customer_id"), F.col("c.state").alias("customer_state"))
        .agg(
            F.count_distinct("o.order_id").alias("total_orders"),
            F.sum(F.col("i.price") + F.col("i.freight_value")).alias("total_spent"),
            F.max("o.order_created_ts").alias("last_order_timestamp"),
        )
    )


def brute_product_performance(i, p, r):
    i, p, r = i.alias("i"), p.alias("p"), r.alias("r")
    return (
        i.join(p, F.col("i.product_id") == F.col("p.product_id"))
        .join(r, F.col("i.order_id") == F.col("r.order_id"), "left")
        .groupBy(F.col("i.product_id").alias("product_id"), F.col("p.category").alias("category"))
        .agg(
            F.count("i.order_id").alias("total_units_sold"),
            F.sum(F.col("i.price") + F.col("i.freight_value")).alias("total_revenue"),
            F.avg("r.review_score").alias("average_review_score"),
        )
    )


def brute_review_insights(r, o, i, p):
    r, o, i, p = r.alias("r"), o.alias("o"), i.alias("i"), p.alias("p")
    return (
        r.join(o, F.col("r.order_id") == F.col("o.order_id"))
        .join(i, F.col("o.order_id") == F.col("i.order_id"))
        .join(p, F.col("i.product_id") == F.col("p.product_id"))
        .select("r.review_id", "r.review_score", "r.review_text", "p.category",
                F.col("o.order_created_ts").alias("order_timestamp"))
    )


def brute_sales_fact(o, i, p, c, s):
    o, i, p, c, s = o.alias("o"), i.alias("i"), p.alias("p"), c.alias("c"), s.alias("s")
    return (
        o.join(i, F.col("o.order_id") == F.col("i.order_id"))
        .join(p, F.col("i.product_id") == F.col("p.product_id"), "left")
        .join(c, F.col("o.customer_id") == F.col("c.customer_id"), "left")
        .join(s, F.col("i.seller_id") == F.col("s.seller_id"), "left")
        .select(
            "o.order_id", F.col("o.order_created_ts").alias("order_timestamp"), "o.customer_id",
            "i.seller_id", "i.product_id", "p.category", "i.price", "i.freight_value",
            (F.col("i.price") + F.col("i.freight_value")).alias("total_amount"),
            F.col("c.city").alias("customer_city"), F.col("c.state").alias("customer_state"),
            F.col("s.city").alias("seller_city"), F.col("s.state").alias("seller_state"),
        )
    )


def approx(table, places=6):
    return [tuple(round(v, places) if isinstance(v, float) else v for v in r) for r in table]


# --- expected values on the fixtures ------------------------------------------

def test_daily_sales_values(fx):
    out = gold.daily_sales(fx.orders(), fx.order_items(), fx.customers())
    assert out.columns == GOLD_COLUMNS["daily_sales"]
    assert rows(out) == [
        (dt.date(2018, 1, 1), "sp", 2, 116.0, 116.0 / 3),
        (dt.date(2018, 1, 2), "rj", 1, 16.0, 8.0),
        (dt.date(2018, 1, 5), "rj", 1, 22.5, 22.5),
        (dt.date(2018, 1, 10), "pr", 1, 11.0, 11.0),
        (None, "rj", 1, 4.0, 4.0),
    ]


def test_customer_ltv_values(fx):
    out = gold.customer_ltv(fx.orders(), fx.order_items(), fx.customers())
    assert out.columns == GOLD_COLUMNS["customer_ltv"]
    assert rows(out) == [
        ("c1", "sp", 2, 116.0, dt.datetime(2018, 1, 1, 23, 59)),
        ("c2", "rj", 1, 22.5, dt.datetime(2018, 1, 5, 10, 0)),
        ("c3", "pr", 1, 11.0, dt.datetime(2018, 1, 10, 8, 0)),
        ("c4", "rj", 2, 20.0, dt.datetime(2018, 1, 2, 9, 0)),
    ]


def test_product_performance_counts_review_fan_out(fx):
    out = gold.product_performance(fx.order_items(), fx.products(), fx.reviews())
    assert out.columns == GOLD_COLUMNS["product_performance"]
    assert rows(out) == [
        ("p1", "health_beauty", 5, 221.5, 4.5),
        ("p2", None, 2, None, 4.5),
        ("p3", None, 2, 26.5, None),
    ]


def test_review_insights_keeps_identical_rows(fx):
    out = gold.review_insights(fx.reviews(), fx.orders(), fx.order_items(), fx.products())
    assert out.columns == GOLD_COLUMNS["review_insights"]
    got = rows(out)
    assert len(got) == 9
    assert got.count(("r5", None, None, "health_beauty", dt.datetime(2018, 1, 1, 9, 0))) == 2
    assert got.count(("r5", None, None, "health_beauty", dt.datetime(2018, 1, 2, 9, 0))) == 2
    assert sum(1 for g in got if g[0] in ("r1", "r2")) == 4


def test_sales_fact_rows(fx):
    out = gold.sales_fact(fx.orders(), fx.order_items(), fx.products(), fx.customers(), fx.sellers())
    assert out.columns == GOLD_COLUMNS["sales_fact"]
    got = rows(out)
    assert len(got) == 9  # items of known orders, repeated order rows multiply
    unknown_product = [g for g in got if g[4] == "p9"]
    assert unknown_product and unknown_product[0][5] is None
    unknown_seller = [g for g in got if g[3] == "s9"]
    assert len(unknown_seller) == 2 and all(g[11] is None for g in unknown_seller)


# --- library plan == brute-force definition -------------------------------------

CASES = {
    "daily_sales": (gold.daily_sales, brute_daily_sales, ("orders", "order_items", "customers")),
    "customer_ltv": (gold.customer_ltv, brute_customer_ltv, ("orders", "order_items", "customers")),
    "product_performance": (
        gold.product_performance, brute_product_performance, ("order_items", "products", "reviews")),
    "review_insights": (
        gold.review_insights, brute_review_insights, ("reviews", "orders", "order_items", "products")),
    "sales_fact": (
        gold.sales_fact, brute_sales_fact, ("orders", "order_items", "products", "customers", "sellers")),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_matches_brute_force_on_fixtures(fx, name):
    fast, brute, inputs = CASES[name]
    args = [getattr(fx, n)() for n in inputs]
    assert rows(fast(*args)) == rows(brute(*args).select(*GOLD_COLUMNS[name]))


@pytest.mark.parametrize("name", sorted(CASES))
def test_matches_brute_force_on_test_tables(sf, name):
    fast, brute, inputs = CASES[name]
    args = [getattr(sf, n)() for n in inputs]
    assert approx(rows(fast(*args))) == approx(rows(brute(*args).select(*GOLD_COLUMNS[name])))


@pytest.mark.parametrize("name", sorted(CASES))
def test_layout_independent_exact_results(spark, sf, name):
    """Same bits under another input layout and partition count (what a retried
    stage or a resized cluster sees)."""
    fast, _, inputs = CASES[name]
    base = rows(fast(*[getattr(sf, n)() for n in inputs]))
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        args = [getattr(sf, n)().repartition(5).sortWithinPartitions(F.rand(7)) for n in inputs]
        assert rows(fast(*args)) == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)


@pytest.mark.parametrize("name", sorted(CASES))
def test_layout_independent_with_partitions_split(spark, sf, name):
    """AQE splits other partitions under another layout; the result must still be bit-identical."""
    from tests.test_skew import AQE_SKEW

    fast, _, inputs = CASES[name]
    conf = {**AQE_SKEW, "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.1"}
    saved = {k: spark.conf.get(k) for k in (*conf, "spark.sql.shuffle.partitions")}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        base = rows(fast(*[getattr(sf, n)() for n in inputs]))
        spark.conf.set("spark.sql.shuffle.partitions", "5")
        args = [getattr(sf, n)().repartition(7).sortWithinPartitions(F.rand(11)) for n in inputs]
        assert rows(fast(*args)) == base
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
