"""

``entry(spark)`` runs the flagship query (gold daily sales) on sf0.001;
``queries()`` maps every implemented job/operator to a ``(spark, sf_dir) ->
DataFrame`` builder over the whole test tables; ``oracle_sql()`` gives, for each
of them, an independent DuckDB query over the same tables, written the
straightforward row-level way (plain fan-out joins, window dedupe), so the
comparison also checks the Spark plans' rewrites (pre-aggregation before joins,
arithmetic review fan-out, reordered joins; split partitions are forced in
``tests/test_oracle.py``).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from emporia.plans.queries import QUERIES  # noqa: E402

# The training-data operators are an optional subpackage: without it, or without
# corpus_pipeline.py, the other queries stay as they are.
try:
    import corpus_pipeline  # noqa: E402
    from emporia.llm.queries import ORACLE_SQL as LLM_SQL  # noqa: E402
    from emporia.llm.queries import QUERIES as LLM_QUERIES  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "emporia.llm", "emporia.llm.queries"):
        raise
    LLM_QUERIES, LLM_SQL = {}, {}
else:
    LLM_QUERIES = {**LLM_QUERIES, "pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        LLM_SQL = {**LLM_SQL, "pipeline": corpus_pipeline.ORACLE_SQL}

FLAGSHIP = "gold_daily_sales"
SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return QUERIES[FLAGSHIP](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**QUERIES, **LLM_QUERIES}


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB). Source datasets are rebuilt from the test tables with the
# same stand-in mapping as emporia.sources.standins; silver and gold follow the
# row-level definitions.
# ---------------------------------------------------------------------------


def _zip_key(expr: str) -> str:
    text = f"trim(CAST({expr} AS VARCHAR))"
    raw = f"CAST({expr} AS VARCHAR)"
    return (
        f"(CASE WHEN regexp_full_match({text}, '[0-9]{{1,4}}') THEN lpad({text}, 5, '0')"
        f" WHEN regexp_full_match({text}, '[0-9]+') THEN {text} ELSE {raw} END)"
    )


# 2**64: the amounts of the test tables are multiples of its inverse, so scaled by it
# they are whole numbers, which a HUGEINT sums exactly.
_SCALE = "1.8446744073709552e19"


def _money_sum(expr: str) -> str:
    return f"(CAST(SUM(CAST(({expr}) * {_SCALE} AS HUGEINT)) AS DOUBLE) / {_SCALE})"


_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "src_orders": ((), """
        SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
               CASE o.o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                                    WHEN 'P' THEN 'processing' END AS order_status,
               o.o_orderdate AS order_purchase_timestamp,
               CASE WHEN o.o_orderstatus = 'F' THEN s.last_ship END AS order_delivered_customer_date
        FROM orders o
        LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) s
          ON o.o_orderkey = s.l_orderkey"""),
    "src_order_items": ((), """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_extendedprice AS price,
               l_extendedprice * l_tax AS freight_value
        FROM lineitem"""),
    "src_customers": ((), """
        SELECT c.c_custkey AS customer_id, c.c_name AS customer_unique_id,
               c.c_nationkey AS customer_zip_code_prefix, n.n_name AS customer_city,
               r.r_name AS customer_state
        FROM customer c
        LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
        LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "src_sellers": ((), """
        SELECT s.s_suppkey AS seller_id, s.s_nationkey AS seller_zip_code_prefix,
               n.n_name AS seller_city, r.r_name AS seller_state
        FROM supplier s
        LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
        LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "src_geolocation": ((), """
        SELECT c_nationkey AS geolocation_zip_code_prefix, c_acctbal AS geolocation_lat,
               CAST(c_custkey AS DOUBLE) AS geolocation_lng
        FROM customer"""),
    "src_products": ((), """
        SELECT p_partkey AS product_id, p_type AS product_category_name,
               p_retailprice AS product_weight_g, p_size AS product_length_cm,
               p_size AS product_height_cm, p_size AS product_width_cm
        FROM part"""),
    "src_product_category_translation": ((), """
        SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
        FROM part WHERE p_type <> 'PROMO'"""),
    "src_order_payments": ((), """
        SELECT o_orderkey AS order_id, ' ' || o_orderpriority || ' ' AS payment_type,
               o_totalprice AS payment_value, o_orderkey % 12 + 1 AS payment_installments
        FROM orders"""),
    "src_order_reviews": ((), """
        SELECT event_id AS review_id, CAST(floor(event_id / 2) AS BIGINT) AS order_id,
               CASE WHEN event_type = 'error' THEN 'n/a'
                    ELSE CAST(TRY_CAST(regexp_replace(props, '[^0-9]', '', 'g') AS BIGINT) % 5 + 1 AS VARCHAR)
               END AS review_score,
               '  ' || event_type || ' ' AS review_comment_message
        FROM events"""),
    "geo_centroid": (("src_geolocation",), f"""
        SELECT {_zip_key('geolocation_zip_code_prefix')} AS geolocation_zip_code_prefix,
               avg(geolocation_lat) AS latitude, avg(geolocation_lng) AS longitude
        FROM src_geolocation GROUP BY 1"""),
    "dedupe_order_items": (("src_order_items",), """
        SELECT order_id, order_item_id, product_id, seller_id, price, freight_value
        FROM src_order_items
        QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id
                                   ORDER BY product_id NULLS FIRST, seller_id NULLS FIRST,
                                            price NULLS FIRST, freight_value NULLS FIRST) = 1"""),
    "silver_customers": (("src_customers", "geo_centroid"), f"""
        SELECT c.customer_id, c.customer_unique_id,
               lower(trim(c.customer_city)) AS city, lower(trim(c.customer_state)) AS state,
               g.latitude, g.longitude
        FROM (SELECT * FROM src_customers
              QUALIFY row_number() OVER (PARTITION BY customer_id
                  ORDER BY customer_unique_id NULLS FIRST, customer_zip_code_prefix NULLS FIRST,
                           customer_city NULLS FIRST, customer_state NULLS FIRST) = 1) c
        LEFT JOIN geo_centroid g
          ON {_zip_key('c.customer_zip_code_prefix')} = g.geolocation_zip_code_prefix"""),
    "silver_sellers": (("src_sellers", "geo_centroid"), f"""
        SELECT s.seller_id, lower(trim(s.seller_city)) AS city, lower(trim(s.seller_state)) AS state,
               g.latitude, g.longitude
        FROM (SELECT * FROM src_sellers
              QUALIFY row_number() OVER (PARTITION BY seller_id
                  ORDER BY seller_zip_code_prefix NULLS FIRST, seller_city NULLS FIRST,
                           seller_state NULLS FIRST) = 1) s
        LEFT JOIN geo_centroid g
          ON {_zip_key('s.seller_zip_code_prefix')} = g.geolocation_zip_code_prefix"""),
    "silver_products": (("src_products", "src_product_category_translation"), """
        SELECT p.product_id, t.product_category_name_english AS category, p.product_weight_g,
               p.product_length_cm, p.product_height_cm, p.product_width_cm
        FROM src_products p
        LEFT JOIN src_product_category_translation t
          ON p.product_category_name = t.product_category_name"""),
    "silver_orders": (("src_orders",), """
        SELECT order_id, customer_id,
               CAST(order_purchase_timestamp AS TIMESTAMP) AS order_created_ts,
               CAST(order_delivered_customer_date AS TIMESTAMP) AS order_delivered_ts,
               order_status,
               CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE),
                              CAST(order_delivered_customer_date AS DATE)) AS INTEGER) AS delivery_days,
               COALESCE(order_status = 'delivered', false) AS is_delivered
        FROM src_orders"""),
    "silver_order_items": (("dedupe_order_items",), """
        SELECT order_id, order_item_id, product_id, seller_id,
               CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value
        FROM dedupe_order_items"""),
    "silver_payments": (("src_order_payments",), """
        SELECT order_id, lower(trim(payment_type)) AS payment_type,
               CAST(payment_value AS DOUBLE) AS payment_value, payment_installments
        FROM src_order_payments"""),
    "silver_reviews": (("src_order_reviews",), """
        SELECT review_id, order_id, TRY_CAST(review_score AS INTEGER) AS review_score,
               trim(review_comment_message) AS review_text
        FROM src_order_reviews"""),
    "gold_sales_fact": (
        ("silver_orders", "silver_order_items", "silver_products", "silver_customers", "silver_sellers"),
        """
        SELECT o.order_id, o.order_created_ts AS order_timestamp, o.customer_id, i.seller_id,
               i.product_id, p.category, i.price, i.freight_value,
               i.price + i.freight_value AS total_amount,
               c.city AS customer_city, c.state AS customer_state,
               s.city AS seller_city, s.state AS seller_state
        FROM silver_orders o
        JOIN silver_order_items i ON o.order_id = i.order_id
        LEFT JOIN silver_products p ON i.product_id = p.product_id
        LEFT JOIN silver_customers c ON o.customer_id = c.customer_id
        LEFT JOIN silver_sellers s ON i.seller_id = s.seller_id"""),
    "gold_daily_sales": (("silver_orders", "silver_order_items", "silver_customers"), f"""
        SELECT CAST(o.order_created_ts AS DATE) AS order_date, c.state AS customer_state,
               count(DISTINCT o.order_id) AS total_orders,
               {_money_sum('i.price + i.freight_value')} AS total_revenue,
               {_money_sum('i.price + i.freight_value')}
                 / count(i.price + i.freight_value) AS avg_order_value
        FROM silver_orders o
        JOIN silver_order_items i ON o.order_id = i.order_id
        JOIN silver_customers c ON o.customer_id = c.customer_id
        GROUP BY 1, 2"""),
    "gold_customer_ltv": (("silver_orders", "silver_order_items", "silver_customers"), f"""
        SELECT o.customer_id, c.state AS customer_state,
               count(DISTINCT o.order_id) AS total_orders,
               {_money_sum('i.price + i.freight_value')} AS total_spent,
               max(o.order_created_ts) AS last_order_timestamp
        FROM silver_orders o
        JOIN silver_order_items i ON o.order_id = i.order_id
        JOIN silver_customers c ON o.customer_id = c.customer_id
        GROUP BY 1, 2"""),
    "gold_product_performance": (("silver_order_items", "silver_products", "silver_reviews"), f"""
        SELECT i.product_id, p.category,
               count(i.order_id) AS total_units_sold,
               {_money_sum('i.price + i.freight_value')} AS total_revenue,
               CAST(sum(r.review_score) AS DOUBLE) / count(r.review_score) AS average_review_score
        FROM silver_order_items i
        JOIN silver_products p ON i.product_id = p.product_id
        LEFT JOIN silver_reviews r ON i.order_id = r.order_id
        GROUP BY 1, 2"""),
    "gold_review_insights": (
        ("silver_reviews", "silver_orders", "silver_order_items", "silver_products"),
        """
        SELECT r.review_id, r.review_score, r.review_text, p.category,
               o.order_created_ts AS order_timestamp
        FROM silver_reviews r
        JOIN silver_orders o ON r.order_id = o.order_id
        JOIN silver_order_items i ON o.order_id = i.order_id
        JOIN silver_products p ON i.product_id = p.product_id"""),
    "catalog_order_totals": (("silver_orders", "silver_order_items"), f"""
        SELECT o.order_id, o.customer_id,
               {_money_sum('i.price + i.freight_value')} AS amount,
               count(i.price + i.freight_value) AS items
        FROM silver_orders o JOIN silver_order_items i ON o.order_id = i.order_id
        GROUP BY 1, 2"""),
    "profile_order_items": (("silver_order_items",), """
        SELECT count(*) AS row_count, CAST(6 AS INTEGER) AS column_count,
               count(*) - count(order_id) AS nulls_order_id,
               count(*) - count(order_item_id) AS nulls_order_item_id,
               count(*) - count(product_id) AS nulls_product_id,
               count(*) - count(seller_id) AS nulls_seller_id,
               count(*) - count(price) AS nulls_price,
               count(*) - count(freight_value) AS nulls_freight_value
        FROM silver_order_items"""),
}


# The faults of emporia.sources.standins.rough, over the plain stand-ins.
_ROUGH: dict[str, str] = {
    "src_customers": """
        SELECT * FROM (SELECT * FROM plain_src_customers
          UNION ALL SELECT * REPLACE ('A ' || customer_unique_id AS customer_unique_id,
                                      (customer_zip_code_prefix + 3) % 25 AS customer_zip_code_prefix)
          FROM plain_src_customers WHERE customer_id % 7 = 0)
        WHERE customer_id % 11 <> 0""",
    "src_sellers": """
        SELECT * FROM (SELECT * FROM plain_src_sellers
          UNION ALL SELECT * REPLACE ((seller_zip_code_prefix + 3) % 25 AS seller_zip_code_prefix)
          FROM plain_src_sellers WHERE seller_id % 3 = 0)
        WHERE seller_id % 7 <> 0""",
    "src_orders": """
        SELECT * FROM (SELECT * FROM plain_src_orders
          UNION ALL SELECT * REPLACE (order_purchase_timestamp + INTERVAL 1 DAY AS order_purchase_timestamp)
          FROM plain_src_orders WHERE order_id % 13 = 0)
        WHERE order_id % 19 <> 0""",
    "src_products": """
        SELECT * FROM (SELECT * FROM plain_src_products
          UNION ALL SELECT * FROM plain_src_products WHERE product_id % 17 = 0)
        WHERE product_id % 5 <> 0""",
    "src_order_items": """
        SELECT * REPLACE (CASE WHEN order_id % 29 <> 0 THEN product_id END AS product_id,
                          CASE WHEN order_item_id <> 3 THEN freight_value END AS freight_value)
        FROM plain_src_order_items""",
    "src_order_reviews": """
        SELECT * REPLACE (CASE WHEN review_id % 23 <> 0 THEN order_id END AS order_id)
        FROM plain_src_order_reviews""",
}


def _with(target: str, rough: bool = False) -> str:
    """``WITH`` the CTEs ``target`` needs (dependencies first), then select it."""
    parts: dict[str, str] = {}

    def visit(name: str) -> None:
        if name in parts:
            return
        for dep in _CTES[name][0]:
            visit(dep)
        faults = _ROUGH.get(name) if rough else None
        if faults:
            parts[f"plain_{name}"] = _CTES[name][1]
        parts[name] = faults or _CTES[name][1]

    visit(target)
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in parts.items())
    return f"WITH {body}\nSELECT * FROM {target}"


def oracle_sql() -> dict[str, str]:
    sql = {name: _with(name) for name in QUERIES if name in _CTES}
    # Bronze round trips return the source dataset unchanged.
    for name in QUERIES:
        if name.startswith("bronze_"):
            sql[name] = _with("src_" + name.removeprefix("bronze_"))
        if name.startswith("rough_"):
            sql[name] = _with(name.removeprefix("rough_"), rough=True)
    return {**sql, **LLM_SQL}
