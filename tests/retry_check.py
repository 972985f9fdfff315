"""Run gold tables with most partitions split by AQE while the first attempt of half
the tasks that read orders and items fails; print whether the results equal a
failure-free run. Needs its own JVM (``local[4,4]``: four attempts per task),
so ``tests/test_retries.py`` runs it as a subprocess:

    python tests/retry_check.py /root/testdata/sf0.001 <marker-dir>
"""

from __future__ import annotations

import json
import os
import sys
import uuid

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(sf_dir: str, marker_dir: str) -> None:
    from pyspark import TaskContext
    from pyspark.sql import functions as F

    from emporia.plans import gold
    from emporia.plans.queries import Silver
    from emporia.session import build_session

    spark = build_session(
        "local[4,4]",
        app_name="emporia-retries",
        shuffle_partitions=4,
        extra_conf={"spark.checkpoint.dir": os.path.join(marker_dir, "ckpt")},
    )
    for key, value in {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }.items():
        spark.conf.set(key, value)

    def fail_first_attempt(_):
        tc = TaskContext.get()
        if tc.attemptNumber() == 0 and tc.partitionId() % 2 == 0:
            open(os.path.join(marker_dir, f"failed-{uuid.uuid4().hex}"), "w").close()
            raise RuntimeError("injected task failure")
        return True

    flaky = F.udf(fail_first_attempt, "boolean").asNondeterministic()
    s = Silver(spark, sf_dir)

    def tables(inject: bool):
        orders, items, reviews = s.orders(), s.order_items(), s.reviews()
        if inject:  # in the stages whose output the joins split
            orders = orders.where(flaky(F.lit(1)))
            items = items.where(flaky(F.lit(1)))
        return {
            "daily_sales": gold.daily_sales(orders, items, s.customers()),
            "product_performance": gold.product_performance(items, s.products(), reviews),
            "review_insights": gold.review_insights(reviews, orders, items, s.products()),
        }

    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    clean = {k: rows(v) for k, v in tables(False).items()}
    flaky_runs = {k: rows(v) for k, v in tables(True).items()}
    failures = len([f for f in os.listdir(marker_dir) if f.startswith("failed-")])
    print(json.dumps({
        "failed_attempts": failures,
        "equal": {k: clean[k] == flaky_runs[k] for k in clean},
        "rows": {k: len(v) for k, v in clean.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
