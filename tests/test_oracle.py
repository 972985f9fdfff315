"""Every registered query against its DuckDB oracle on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from emporia.plans.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare

# The jobs' own queries; those of the optional operators are tested beside them.
NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    rec = compare(spark, SF_SMALL, [name])[name]
    assert rec["ok"], rec


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_date", "customer_state", "total_orders", "total_revenue", "avg_order_value"]
    assert df.count() > 0


SPLIT_JOINS = [n for n in NAMES if n.startswith(("silver_customers", "silver_sellers", "silver_products", "gold_"))]


@pytest.mark.parametrize("name", SPLIT_JOINS)
def test_query_matches_oracle_with_every_large_partition_split(spark, name):
    """AQE's skew thresholds below the test tables' partition sizes, nothing broadcast:
    the balanced joins' partitions are split over tasks, and results must not change."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    saved = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rec = compare(spark, SF_SMALL, [name])[name]
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert rec["ok"], rec


def test_rough_stand_ins_hold_the_faults(spark):
    """The rough queries would show nothing if their inputs had no repeats and no orphans."""
    from emporia.sources import standins

    def keys(name, key):
        frame = standins.rough(spark, SF_SMALL, name)
        return frame.count(), {r[0] for r in frame.select(key).distinct().collect()}

    n_customers, customers = keys("customers", "customer_id")
    n_orders, orders = keys("orders", "order_id")
    n_products, products = keys("products", "product_id")
    assert n_customers > len(customers) and n_orders > len(orders) and n_products > len(products)
    placed = {r[0] for r in standins.rough(spark, SF_SMALL, "orders").select("customer_id").collect()}
    items = standins.rough(spark, SF_SMALL, "order_items").select("order_id", "product_id").collect()
    assert placed - customers and {r.order_id for r in items} - orders
    assert {r.product_id for r in items} - products - {None} and None in {r.product_id for r in items}


def test_catalog_query_reads_bucketed_tables_without_a_shuffle(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        plan = QUERIES["catalog_order_totals"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
