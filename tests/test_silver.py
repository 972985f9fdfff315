from __future__ import annotations

import datetime as dt
import os

import pytest

from emporia.plans import silver
from emporia.sources import SILVER_COLUMNS, Registry, read_source
from tests.conftest import rows
from tests.fixtures import write_landing


@pytest.fixture(scope="module")
def src(spark, tmp_path_factory):
    landing = write_landing(os.path.join(str(tmp_path_factory.mktemp("silver")), "landing"))
    reg = Registry(landing_root=landing)
    return lambda name: read_source(spark, name, reg)


def test_customers(src):
    out = silver.customers(src("customers"), src("geolocation"))
    assert out.columns == SILVER_COLUMNS["customers"]
    assert rows(out) == [
        ("c1", "u1", "sao paulo", "sp", -23.5, -46.5),
        ("c2", "u2", "rio de janeiro", "rj", None, None),
        ("c3", "u3", "curitiba", "pr", None, None),
        ("c4", "u4", "niteroi", "rj", -22.75, -43.25),
    ]


def test_sellers(src):
    out = silver.sellers(src("sellers"), src("geolocation"))
    assert out.columns == SILVER_COLUMNS["sellers"]
    assert rows(out) == [
        ("s1", "angra", "rj", -22.75, -43.25),
        ("s2", "belo horizonte", "mg", None, None),
    ]


def test_products(src):
    out = silver.products(src("products"), src("product_category_translation"))
    assert out.columns == SILVER_COLUMNS["products"]
    assert rows(out) == [
        ("p1", "health_beauty", 500, 10, 11, 12),
        ("p2", None, 100, 5, 5, 5),
        ("p3", None, 200, None, None, None),
    ]


def test_orders(src):
    out = silver.orders(src("orders"))
    assert out.columns == SILVER_COLUMNS["orders"]
    assert dict(out.dtypes)["order_created_ts"] == "timestamp_ntz"
    got = {(r.order_id, r.customer_id): r for r in out.collect()}
    assert got[("o1", "c1")].delivery_days == 1
    assert got[("o1", "c1")].is_delivered is True
    assert got[("o2", "c2")].delivery_days is None
    assert got[("o2", "c2")].is_delivered is False
    assert got[("o3", "c3")].delivery_days == -5
    assert got[("o4", "c9")].is_delivered is False  # NULL status
    assert got[("o5", "c4")].order_created_ts is None
    assert got[("o5", "c4")].is_delivered is True
    assert out.count() == 7  # repeated o6 kept
    assert got[("o6", "c4")].order_created_ts == dt.datetime(2018, 1, 2, 9, 0)


def test_order_items_dedupes_key(src):
    out = silver.order_items(src("order_items"))
    assert out.columns == SILVER_COLUMNS["order_items"]
    got = rows(out)
    assert len(got) == 8
    assert ("o1", 1, "p1", "s1", 90.0, 10.0) in got
    assert ("o1", 2, "p2", "s2", 50.5, None) in got


def test_payments(src):
    out = silver.payments(src("order_payments"))
    assert out.columns == SILVER_COLUMNS["payments"]
    assert rows(out) == [("o1", "credit_card", 110.0, 3), ("o2", "boleto", 22.5, 1)]


def test_reviews(src):
    out = silver.reviews(src("order_reviews"))
    assert out.columns == SILVER_COLUMNS["reviews"]
    got = {r.review_id: (r.review_score, r.review_text) for r in out.collect()}
    assert got == {
        "r1": (5, 'Great, fast "really" good\nsecond line'),
        "r2": (4, "ends in tab\t"),
        "r3": (None, None),
        "r4": (None, "ok"),
        "r5": (None, None),
        "r6": (3, "unknown order"),
    }


def test_dimension_jobs_do_not_grow_the_left_side(src):
    assert silver.customers(src("customers"), src("geolocation")).count() == 4
    assert silver.products(src("products"), src("product_category_translation")).count() == 3
