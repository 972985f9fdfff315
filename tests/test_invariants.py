"""Cross-table invariants of the gold layer on the smallest test tables.

The test tables have unique order, customer and product keys, so the row-level
definitions reduce to simple counts and sums that each gold table must agree on.
"""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from emporia.plans import gold
from emporia.plans.queries import Silver
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def s(spark):
    return Silver(spark, SF_SMALL)


def _close(a, b):
    return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-6)


def test_sales_fact_has_one_row_per_item_of_a_known_order(s):
    items, orders = s.order_items(), s.orders()
    known = items.join(orders.select("order_id"), "order_id", "left_semi").count()
    assert gold.sales_fact(orders, items, s.products(), s.customers(), s.sellers()).count() == known


def test_customers_have_one_row_per_customer_id(s):
    assert s.customers().count() == s.src("customers").select("customer_id").distinct().count()


def test_revenue_agrees_across_sales_fact_daily_sales_and_ltv(s):
    orders, items, customers = s.orders(), s.order_items(), s.customers()
    fact = gold.sales_fact(orders, items, s.products(), customers, s.sellers())
    fact_total = fact.where(F.col("customer_state").isNotNull()).agg(F.sum("total_amount")).first()[0]
    daily = gold.daily_sales(orders, items, customers).agg(
        F.sum("total_revenue"), F.sum("total_orders")
    ).first()
    ltv = gold.customer_ltv(orders, items, customers).agg(F.sum("total_spent"), F.sum("total_orders")).first()
    assert _close(daily[0], fact_total) and _close(ltv[0], fact_total)
    # every known order lands in exactly one (date, state) group and one customer group
    orders_with_items = fact.where(F.col("customer_state").isNotNull()).select("order_id").distinct().count()
    assert daily[1] == ltv[1] == orders_with_items


def test_product_units_count_each_item_once_per_review(s):
    items, products, reviews = s.order_items(), s.products(), s.reviews()
    per_order = reviews.groupBy("order_id").count()
    expected = (
        items.join(products.select("product_id"), "product_id")
        .join(per_order, "order_id", "left")
        .agg(F.sum(F.coalesce("count", F.lit(1))))
        .first()[0]
    )
    got = gold.product_performance(items, products, reviews).agg(F.sum("total_units_sold")).first()[0]
    assert got == expected


def test_review_insights_rows_are_reviews_times_items(s):
    reviews, orders, items, products = s.reviews(), s.orders(), s.order_items(), s.products()
    n_reviews = reviews.join(orders.select("order_id"), "order_id").groupBy("order_id").count()
    n_items = items.join(products.select("product_id"), "product_id").groupBy("order_id").count()
    expected = (
        n_reviews.alias("r").join(n_items.alias("i"), "order_id")
        .agg(F.sum(F.col("r.count") * F.col("i.count")))
        .first()[0]
    )
    assert gold.review_insights(reviews, orders, items, products).count() == expected
