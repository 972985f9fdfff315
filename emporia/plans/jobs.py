"""The table jobs and their dependency order.

21 jobs: nine bronze ingests, seven silver and five gold tables. Jobs exchange
data only through written tables, which also cuts lineage: a gold job restarted
after an executor loss recomputes from silver files, not from the raw CSVs.
Every write is a full overwrite, so rerunning a job is safe.

Run one job, a layer, or everything:

    python -m emporia.plans.jobs silver-customers --landing /data/landing --catalog main
    python -m emporia.plans.jobs all --landing /data/landing --warehouse-root /data/wh

With ``--buckets N`` (catalog layout only) the silver tables keyed by order_id
are written bucketed on it; gold jobs then aggregate items and reviews per
order without shuffling them. Joins on order_id keep them bucket-aligned only
with ``--no-split`` (joins that AQE cannot split), which is safe only when no
order holds a large share of the rows; a bucket cannot be split either.

``--read-option dataset.name=value`` sets a CSV reader option of one dataset,
``--infer-undeclared dataset`` infers the types of the columns it does not declare.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from emporia.operators.profile import log_observed, observed
from emporia.operators.skew import SPLIT_CONF
from emporia.session import RECOMMENDED_CONF, shuffle_partitions_for
from emporia.plans import gold, silver
from emporia.plans.bronze import BRONZE_DATASETS
from emporia.sources.landing import read_source
from emporia.sources.registry import Registry
from emporia.sources.tables import Warehouse, read_layer, write_layer

# Silver tables bucketed on their order key when bucketing is requested.
ORDER_KEYED = {"orders": "order_id", "order_items": "order_id", "reviews": "order_id"}


@dataclass(frozen=True)
class Job:
    layer: str
    dataset: str
    inputs: tuple[tuple[str, str], ...]
    build: Callable[..., DataFrame] | None

    @property
    def name(self) -> str:
        return f"{self.layer}-{self.dataset.replace('_', '-')}"


def _jobs() -> list[Job]:
    jobs = [Job("bronze", d, (), None) for d in BRONZE_DATASETS]
    b = lambda d: ("bronze", d)
    s = lambda d: ("silver", d)
    jobs += [
        Job("silver", "customers", (b("customers"), b("geolocation")), silver.customers),
        Job("silver", "sellers", (b("sellers"), b("geolocation")), silver.sellers),
        Job("silver", "products", (b("products"), b("product_category_translation")), silver.products),
        Job("silver", "orders", (b("orders"),), silver.orders),
        Job("silver", "order_items", (b("order_items"),), silver.order_items),
        Job("silver", "payments", (b("order_payments"),), silver.payments),
        Job("silver", "reviews", (b("order_reviews"),), silver.reviews),
        Job(
            "gold",
            "sales_fact",
            (s("orders"), s("order_items"), s("products"), s("customers"), s("sellers")),
            gold.sales_fact,
        ),
        Job("gold", "daily_sales", (s("orders"), s("order_items"), s("customers")), gold.daily_sales),
        Job("gold", "customer_ltv", (s("orders"), s("order_items"), s("customers")), gold.customer_ltv),
        Job(
            "gold",
            "product_performance",
            (s("order_items"), s("products"), s("reviews")),
            gold.product_performance,
        ),
        Job(
            "gold",
            "review_insights",
            (s("reviews"), s("orders"), s("order_items"), s("products")),
            gold.review_insights,
        ),
    ]
    return jobs


JOBS: dict[str, Job] = {job.name: job for job in _jobs()}
LAYER_ORDER = ("bronze", "silver", "gold")

# Settings of the caller's session that a job's own session keeps (newSession starts
# from the context's settings, not from what was set at run time).
_SHARED_CONF = (*RECOMMENDED_CONF, SPLIT_CONF)


def inputs(job: Job, spark: SparkSession, warehouse: Warehouse) -> list[DataFrame]:
    """The job's input frames: its landing file (bronze) or the tables it reads."""
    if job.build is None:
        return [read_source(spark, job.dataset, warehouse.registry)]
    return [read_layer(spark, dataset, layer, warehouse) for layer, dataset in job.inputs]


def plan(job: Job, spark: SparkSession, warehouse: Warehouse) -> DataFrame:
    """The job's output DataFrame (lazy; nothing is written)."""
    frames = inputs(job, spark, warehouse)
    return frames[0] if job.build is None else job.build(*frames)


def run_job(
    spark: SparkSession,
    name: str,
    warehouse: Warehouse,
    buckets: int | None = None,
    profile: bool = False,
    shuffle_partitions: int | None = None,
) -> str:
    """Write one job's table. ``profile`` logs its columns, counts and a preview: the counts
    are observed while the table is written, the preview is read from it; failures only warn.

    Shuffle partitions are sized from the job's input bytes
    (``session.shuffle_partitions_for``) unless ``shuffle_partitions`` is given, and set
    in a session of the job's own that shares the caller's context and catalog.
    """
    job = JOBS[name]
    own = spark.newSession()
    for key in _SHARED_CONF:
        if (value := spark.conf.get(key, None)) is not None:
            own.conf.set(key, value)
    if shuffle_partitions is None:
        shuffle_partitions = shuffle_partitions_for(own, inputs(job, own, warehouse))
    own.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    df = plan(job, own, warehouse)
    df, seen = observed(df) if profile else (df, None)
    bucket_by = None
    if buckets and warehouse.root is None and job.layer == "silver" and job.dataset in ORDER_KEYED:
        bucket_by = (buckets, ORDER_KEYED[job.dataset])
    where = write_layer(df, job.dataset, job.layer, warehouse, bucket_by=bucket_by)
    if seen is not None:
        written = read_layer(own, job.dataset, job.layer, warehouse)
        log_observed(seen, written, logging.getLogger(f"emporia.{name}"))
    return where


def ordered(names: Sequence[str]) -> list[str]:
    """Jobs in dependency order (every input table is written before its readers)."""
    rank = {layer: i for i, layer in enumerate(LAYER_ORDER)}
    return sorted(names, key=lambda n: (rank[JOBS[n].layer], list(JOBS).index(n)))


def run_all(
    spark: SparkSession,
    warehouse: Warehouse,
    layers: Sequence[str] = LAYER_ORDER,
    buckets: int | None = None,
    profile: bool = False,
    shuffle_partitions: int | None = None,
) -> list[str]:
    names = ordered([n for n, j in JOBS.items() if j.layer in layers])
    return [run_job(spark, n, warehouse, buckets, profile, shuffle_partitions) for n in names]


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("jobs", nargs="+", help="job names, a layer (bronze/silver/gold) or 'all'")
    parser.add_argument("--landing", default=".", help="folder holding the source CSV files")
    parser.add_argument("--warehouse-root", default=None, help="write parquet under this path")
    parser.add_argument("--catalog", default=None, help="catalog prefix for table names")
    parser.add_argument("--buckets", type=int, default=None, help="bucket order-keyed silver tables")
    parser.add_argument("--profile", action="store_true", help="log a profile of each table before writing")
    parser.add_argument(
        "--shuffle-partitions",
        type=int,
        default=None,
        help="fixed shuffle partitions (default: sized per job from its input bytes)",
    )
    parser.add_argument(
        "--no-split",
        action="store_true",
        help="plain joins that keep bucket alignment, without the shuffles that let AQE split hot keys",
    )
    parser.add_argument(
        "--read-option",
        action="append",
        default=[],
        metavar="DATASET.NAME=VALUE",
        help="CSV reader option of one dataset, such as orders.sep=; (may be repeated)",
    )
    parser.add_argument(
        "--infer-undeclared",
        action="append",
        default=[],
        metavar="DATASET",
        help="infer the types of the columns that this dataset does not declare (may be repeated)",
    )
    args = parser.parse_args(argv)
    if args.profile:
        logging.basicConfig(level=logging.DEBUG, format="%(asctime)s %(name)s %(levelname)s %(message)s")

    names: list[str] = []
    for arg in args.jobs:
        if arg == "all":
            names += list(JOBS)
        elif arg in LAYER_ORDER:
            names += [n for n, j in JOBS.items() if j.layer == arg]
        elif arg in JOBS:
            names.append(arg)
        else:
            parser.error(f"unknown job {arg!r}; known: {', '.join(JOBS)}")

    options: dict[str, dict[str, str]] = {}
    for text in args.read_option:
        target, _, value = text.partition("=")
        dataset, _, option = target.partition(".")
        if dataset not in BRONZE_DATASETS or not option:
            parser.error(f"not a dataset's reader option: {text!r}")
        options.setdefault(dataset, {})[option] = value
    for dataset in args.infer_undeclared:
        if dataset not in BRONZE_DATASETS:
            parser.error(f"unknown dataset {dataset!r}")

    from emporia.session import build_session

    spark = build_session(app_name="emporia-jobs")
    if args.no_split:
        spark.conf.set(SPLIT_CONF, "false")
    registry = Registry(
        landing_root=args.landing,
        catalog=args.catalog,
        options=options,
        infer_undeclared=frozenset(args.infer_undeclared),
    )
    warehouse = Warehouse(registry, args.warehouse_root)
    for name in ordered(list(dict.fromkeys(names))):
        out = run_job(spark, name, warehouse, args.buckets, args.profile, args.shuffle_partitions)
        print(name, "->", out, flush=True)


if __name__ == "__main__":
    main()
