from __future__ import annotations

import os

from emporia.plans import jobs
from emporia.sources import GOLD_COLUMNS, Registry, Warehouse, read_layer
from tests.conftest import rows
from tests.fixtures import write_landing
from tests.test_gold import FixtureSilver


def test_dag_has_every_job_in_dependency_order():
    assert len(jobs.JOBS) == 21
    order = jobs.ordered(list(jobs.JOBS))
    seen: set[tuple[str, str]] = set()
    for name in order:
        job = jobs.JOBS[name]
        assert all(dep in seen for dep in job.inputs), name
        seen.add((job.layer, job.dataset))


def test_run_all_path_layout_matches_direct_plans(spark, workdir):
    landing = write_landing(os.path.join(workdir, "landing"))
    wh = Warehouse(Registry(landing_root=landing), root=os.path.join(workdir, "wh"))
    written = jobs.run_all(spark, wh)
    assert len(written) == 21
    fx = FixtureSilver(spark, landing)
    from emporia.plans import gold

    expected = {
        "daily_sales": gold.daily_sales(fx.orders(), fx.order_items(), fx.customers()),
        "product_performance": gold.product_performance(fx.order_items(), fx.products(), fx.reviews()),
        "review_insights": gold.review_insights(fx.reviews(), fx.orders(), fx.order_items(), fx.products()),
    }
    for name, df in expected.items():
        got = read_layer(spark, name, "gold", wh)
        assert got.columns == GOLD_COLUMNS[name]
        assert rows(got) == rows(df)


def test_bucketed_silver_lets_gold_skip_the_order_shuffle(spark, workdir):
    landing = write_landing(os.path.join(workdir, "landing"))
    wh = Warehouse(Registry(landing_root=landing), root=None)
    for name in jobs.ordered([n for n in jobs.JOBS if jobs.JOBS[n].layer in ("bronze", "silver")]):
        jobs.run_job(spark, name, wh, buckets=4)
    items = read_layer(spark, "order_items", "silver", wh)
    orders = read_layer(spark, "orders", "silver", wh)
    from emporia.plans.gold import item_totals_by_order

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        joined = orders.join(item_totals_by_order(items), "order_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    out = jobs.plan(jobs.JOBS["gold-daily-sales"], spark, wh)
    fx = FixtureSilver(spark, landing)
    from emporia.plans import gold

    assert rows(out) == rows(gold.daily_sales(fx.orders(), fx.order_items(), fx.customers()))


def test_profile_comes_from_the_write_itself(spark, workdir, caplog):
    import logging

    landing = write_landing(os.path.join(workdir, "landing"))
    wh = Warehouse(Registry(landing_root=landing), root=os.path.join(workdir, "wh"))
    tracker = spark.sparkContext.statusTracker()

    def jobs_run(**kwargs):
        spark.sparkContext.setJobGroup(f"profile-{kwargs}", "")
        jobs.run_job(spark, "bronze-sellers", wh, shuffle_partitions=2, **kwargs)
        return len(tracker.getJobIdsForGroup(f"profile-{kwargs}"))

    with caplog.at_level(logging.DEBUG, logger="emporia.bronze-sellers"):
        without, with_profile = jobs_run(), jobs_run(profile=True)
    text = caplog.text
    assert "row count: 3" in text and "columns (4)" in text and "'seller_zip_code_prefix': 1" in text
    assert "row 1:" in text
    # beside the write itself only the preview, a limit over the written table (and its footer's schema)
    assert with_profile <= without + 2


def test_byte_sizes_in_spark_notation():
    from emporia.session import byte_size

    assert byte_size("128m") == 128 << 20
    assert byte_size("64MB") == 64 << 20
    assert byte_size("1048576") == 1 << 20
    assert byte_size("1.5g") == 3 << 29


def test_shuffle_partitions_follow_input_bytes(spark):
    from emporia import session

    path = "/root/testdata/sf0.1/lineitem.parquet"
    df = spark.read.parquet(path)
    size = os.path.getsize(path)
    assert session.input_bytes(df) == size  # file-index metadata, no data read
    saved = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        want = -(-size * session.SHUFFLE_BYTES_PER_INPUT_BYTE // (1 << 20))
        assert session.shuffle_partitions_for(spark, [df]) == max(session.MIN_SHUFFLE_PARTITIONS, want)
        assert session.shuffle_partitions_for(spark, [df, df]) >= session.shuffle_partitions_for(spark, [df])
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1t")
        assert session.shuffle_partitions_for(spark, [df]) == session.MIN_SHUFFLE_PARTITIONS
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1")
        assert session.shuffle_partitions_for(spark, [df]) == size * session.SHUFFLE_BYTES_PER_INPUT_BYTE
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", saved)


def test_run_job_leaves_the_session_settings_alone(spark, workdir):
    landing = write_landing(os.path.join(workdir, "landing"))
    wh = Warehouse(Registry(landing_root=landing), root=os.path.join(workdir, "wh"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    jobs.run_job(spark, "bronze-customers", wh, shuffle_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_bronze_jobs_infer_and_read_as_the_registry_says(spark, workdir):
    landing = write_landing(os.path.join(workdir, "landing"))
    registry = Registry(landing_root=landing, infer_undeclared=frozenset({"products"}))
    wh = Warehouse(registry, root=os.path.join(workdir, "wh"))
    jobs.run_job(spark, "bronze-products", wh)
    assert dict(read_layer(spark, "products", "bronze", wh).dtypes)["product_name_lenght"] == "int"
