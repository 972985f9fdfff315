"""Rows per task in product_performance when one order holds a third of the items.

Derives items from the test tables with a third of them moved onto order 1,
runs product_performance with broadcasts and partition coalescing off (so each
shuffle partition is one task, the at-scale shape), and reports, from Spark's
event log, the most and the median shuffle records read by one task for the
busiest stages:

    python tests/hot_key_balance.py /root/testdata/sf0.1 plain   # plain joins
    python tests/hot_key_balance.py /root/testdata/sf0.1 split   # joins that AQE can split

AQE's skew-join thresholds are lowered to this data size.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(sf_dir: str, joins: str) -> None:
    import zstandard
    from pyspark.sql import functions as F

    from emporia.operators.skew import SPLIT_CONF
    from emporia.plans import gold
    from emporia.plans.queries import Silver
    from emporia.session import build_session

    scratch = tempfile.mkdtemp(prefix="emporia-hot-")
    spark = build_session(
        "local[8]",
        app_name="emporia-hot-key-balance",
        shuffle_partitions=16,
        extra_conf={
            "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": scratch,
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        },
    )
    spark.conf.set(SPLIT_CONF, "false" if joins == "plain" else "true")
    s = Silver(spark, sf_dir)
    third = F.pmod(F.xxhash64("order_id", "order_item_id"), F.lit(3)) == 0
    items = s.order_items().withColumn(
        "order_id", F.when(third, F.lit(1).cast("bigint")).otherwise(F.col("order_id"))
    )
    df = gold.product_performance(items, s.products(), s.reviews())
    df.write.format("noop").mode("overwrite").save()  # warm-up
    start = int(time.time() * 1000)
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    wall = time.perf_counter() - t0
    spark.stop()

    log = sorted(glob.glob(os.path.join(scratch, "*", "events*")))[-1]
    stages: dict[int, list[int]] = {}
    for line in io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(log, "rb")), encoding="utf-8"):
        ev = json.loads(line)
        if ev["Event"] != "SparkListenerTaskEnd" or ev["Task Info"]["Launch Time"] < start:
            continue
        metrics = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
        stages.setdefault(ev["Stage ID"], []).append(metrics.get("Total Records Read", 0))
    busiest = sorted(
        ((max(r), sorted(r)[len(r) // 2], len(r)) for r in stages.values() if max(r) > 0), reverse=True
    )
    print(json.dumps({
        "joins": joins,
        "wall_sec": round(wall, 2),
        "busiest_stages": [{"max_records": m, "median_records": md, "tasks": n} for m, md, n in busiest[:3]],
    }))


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
