"""Gold tables: the sales fact and four analytics tables over the silver layer.

Semantics follow the row-level definitions exactly:

* daily_sales / customer_ltv aggregate the rows of ``orders JOIN items JOIN
  customers`` (one row per order row x item);
* product_performance aggregates ``items JOIN products LEFT JOIN reviews``, so an
  item is counted once per review of its order;
* review_insights emits one row per (review, item) of an order, identical rows
  included.

Plans are shaped for scale without changing a result:

* Items are summed per order *before* the order-level joins (partial
  aggregation map-side), so the customer join and the final aggregate see one
  row per order instead of one per item. Money sums are exact integer sums of
  exact decimals (``operators.money``), so regrouping them cannot change a bit.
* Reviews are summarised per order before the product-performance join: the
  review fan-out is reproduced arithmetically (counts and sums multiplied by the
  number of reviews) instead of materialising item x review pairs.
* Every join of a large frame with a frame that may reach it already partitioned
  on the key (an aggregate, a deduplicated dimension) is a ``balanced_join``: both
  inputs get the join's own shuffle, the shape in which AQE splits a partition
  that a hot key (or the NULL keys of a left join) makes far larger than the others.
* The other joins of two large frames (orders x items in the sales fact, the
  review x item fan-out) have that shape as they are.
* No broadcast hints and no counting passes: AQE broadcasts a side, or splits a
  partition, only after measuring it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions import calendar_day, line_total
from emporia.operators import balanced_join, mean_of, money_sums


def item_totals_by_order(order_items: DataFrame) -> DataFrame:
    """Per order_id: exact sum of ``price + freight`` (its bins) and the count of non-NULL amounts."""
    items = order_items.select("order_id", line_total("price", "freight_value").alias("amount"))
    return items.groupBy("order_id").agg(
        money_sums(order_items.sparkSession).sum("amount").alias("amount_sum"),
        F.count("amount").alias("amount_n"),
    )


def _orders_with_totals(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Order rows that have items, with their item totals (``orders JOIN items``
    collapsed to one row per order row; repeated order rows stay repeated)."""
    return balanced_join(
        orders.select("order_id", "customer_id", "order_created_ts"),
        item_totals_by_order(order_items),
        "order_id",
    )


def daily_sales(orders: DataFrame, order_items: DataFrame, customers: DataFrame) -> DataFrame:
    """Per (order date, customer state): distinct orders, revenue, mean item total."""
    rows = balanced_join(
        _orders_with_totals(orders, order_items), customers.select("customer_id", "state"), "customer_id"
    )
    sums = money_sums(orders.sparkSession)
    days = rows.groupBy(
        calendar_day("order_created_ts").alias("order_date"),
        F.col("state").alias("customer_state"),
    ).agg(
        F.count_distinct("order_id").alias("total_orders"),
        sums.merged("amount_sum").alias("amount_sum"),
        F.sum("amount_n").alias("amount_n"),
    )
    return days.withColumn("total_revenue", sums.value("amount_sum")).select(
        "order_date",
        "customer_state",
        "total_orders",
        "total_revenue",
        mean_of(F.col("total_revenue"), F.col("amount_n")).alias("avg_order_value"),
    )


def customer_ltv(orders: DataFrame, order_items: DataFrame, customers: DataFrame) -> DataFrame:
    """Per (customer, state): distinct orders, total spent, last order time.

    Orders are summarised per customer *before* customers are joined, so the
    join sees at most one row per customer on the order side: a customer holding
    any share of the orders is absorbed by partial aggregation map-side. The
    customers table is deduplicated on its key, so neither side of this join can
    hold a hot key, and a plain join serves: its partitioning on customer_id is
    also the last aggregate's. A customer row that is listed k times with one state
    all the same stands for k copies of each joined row: the money sum is multiplied
    by k, the distinct count and the latest time are unchanged.
    """
    sums = money_sums(orders.sparkSession)
    per_customer = (
        _orders_with_totals(orders, order_items)
        .groupBy("customer_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            sums.merged("amount_sum").alias("amount_sum"),
            F.max("order_created_ts").alias("last_order_timestamp"),
        )
    )
    rows = customers.select("customer_id", "state").join(per_customer, "customer_id")
    states = rows.groupBy("customer_id", F.col("state").alias("customer_state")).agg(
        F.first("total_orders").alias("total_orders"),
        sums.merged("amount_sum").alias("amount_sum"),
        F.first("last_order_timestamp").alias("last_order_timestamp"),
    )
    return states.select(
        "customer_id", "customer_state", "total_orders", sums.value("amount_sum").alias("total_spent"), "last_order_timestamp"
    )


def review_summary_by_order(reviews: DataFrame) -> DataFrame:
    """Per order_id: number of reviews, sum and count of non-NULL scores."""
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("score_n"),
    )


def product_performance(order_items: DataFrame, products: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per (product, category) over ``items JOIN products LEFT JOIN reviews`` rows.

    An item whose order has k >= 1 reviews stands for k rows; with none, one
    row with a NULL score. Units count the rows with a non-NULL order_id.
    """
    items = order_items.select(
        "order_id", "product_id", line_total("price", "freight_value").alias("amount")
    )
    lines = balanced_join(items, products.select("product_id", "category"), "product_id")
    rows = balanced_join(lines, review_summary_by_order(reviews), "order_id", "left")
    sums = money_sums(order_items.sparkSession)
    counted = rows.withColumn("copies", F.coalesce("n_reviews", F.lit(1).cast("bigint")))
    totals = counted.groupBy("product_id", "category").agg(
        F.sum(F.when(F.col("order_id").isNotNull(), F.col("copies")).otherwise(F.lit(0).cast("bigint"))).alias(
            "total_units_sold"
        ),
        sums.sum("amount", times="copies").alias("amount_sum"),
        mean_of(F.sum("score_sum"), F.sum("score_n")).alias("average_review_score"),
    )
    return totals.select(
        "product_id", "category", "total_units_sold", sums.value("amount_sum").alias("total_revenue"), "average_review_score"
    )


def review_insights(
    reviews: DataFrame, orders: DataFrame, order_items: DataFrame, products: DataFrame
) -> DataFrame:
    """One row per review x item of the reviewed order, with the item's category.

    The result is the (review, item) pairs themselves, so it is emitted in
    full. The inner joins are associative; they are grouped so that the items
    (two narrow columns) first meet their order rows and products, both
    balanced joins, and the reviews meet those dated, categorised items last.
    Both inputs of that fan-out join arrive through their own shuffle on
    order_id, which is the shape AQE's skew-join handling needs: a hot order's
    partition is split across tasks and the other side's matching partition
    replicated, instead of one task emitting all of that order's pairs.
    (Joining reviews to orders first would feed the fan-out join an input
    already partitioned on order_id, which AQE cannot split.) The wide review
    text crosses the network once.
    """
    items = order_items.select("order_id", "product_id")
    dated = balanced_join(items, orders.select("order_id", "order_created_ts"), "order_id")
    categorised = balanced_join(dated, products.select("product_id", "category"), "product_id")
    return reviews.select("review_id", "order_id", "review_score", "review_text").join(
        categorised, "order_id"
    ).select(
        "review_id",
        "review_score",
        "review_text",
        "category",
        F.col("order_created_ts").alias("order_timestamp"),
    )


def sales_fact(
    orders: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    sellers: DataFrame,
) -> DataFrame:
    """One row per item of a known order, with product, customer and seller attributes.

    Orders meet customers before items (order-level rows are the ones shuffled
    by customer_id); this left join commutes with the inner join on order_id.
    The order x item join has two large inputs, each through its own shuffle,
    so AQE splits a hot order there; the dimension lookups are balanced joins.
    """
    items = order_items.select("order_id", "product_id", "seller_id", "price", "freight_value")
    ordered = balanced_join(
        orders.select("order_id", "customer_id", "order_created_ts"),
        customers.select(
            "customer_id", F.col("city").alias("customer_city"), F.col("state").alias("customer_state")
        ),
        "customer_id",
        "left",
    )
    rows = ordered.join(items, "order_id")
    rows = balanced_join(rows, products.select("product_id", "category"), "product_id", "left")
    rows = balanced_join(
        rows,
        sellers.select("seller_id", F.col("city").alias("seller_city"), F.col("state").alias("seller_state")),
        "seller_id",
        "left",
    )
    return rows.select(
        "order_id",
        F.col("order_created_ts").alias("order_timestamp"),
        "customer_id",
        "seller_id",
        "product_id",
        "category",
        "price",
        "freight_value",
        line_total("price", "freight_value").alias("total_amount"),
        "customer_city",
        "customer_state",
        "seller_city",
        "seller_state",
    )
