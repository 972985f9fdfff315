from __future__ import annotations

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from emporia.sources import (
    SOURCE_SCHEMAS,
    Registry,
    Warehouse,
    read_csv,
    read_layer,
    read_source,
    write_csv,
    write_layer,
)
from tests.conftest import rows
from tests.fixtures import write_landing


@pytest.fixture()
def registry(workdir):
    return Registry(landing_root=write_landing(os.path.join(workdir, "landing")))


def test_registry_paths_and_names():
    reg = Registry(landing_root="/Volumes/data/landing/")
    assert reg.source_path("orders") == "/Volumes/data/landing/olist_orders_dataset.csv"
    assert Registry(landing_root="dbfs:/x").source_path("sellers").startswith("dbfs:/x/")
    assert reg.table_name("customers", "bronze") == "bronze.bronze_customers"
    assert reg.table_name("payments", "silver", qualified=False) == "silver_payments"
    assert Registry(catalog="main").table_name("daily_sales", "gold") == "main.gold.gold_daily_sales"
    with pytest.raises(KeyError):
        reg.source_path("nope")
    with pytest.raises(KeyError):
        reg.table_name("customers", "platinum")
    with pytest.raises(KeyError):
        reg.table_name("payments", "bronze")


def test_casts_by_name_and_keeps_undeclared_columns(spark, registry):
    df = read_source(spark, "customers", registry)
    assert df.columns == [
        "customer_id",
        "customer_unique_id",
        "customer_note",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ]
    zips = [r[0] for r in df.select("customer_zip_code_prefix").collect()]
    assert zips == ["1151", "01151", "99999", None, "20000"]  # leading zero kept, text


def test_typed_columns(spark, registry):
    items = read_source(spark, "order_items", registry)
    assert dict(items.dtypes)["price"] == "double"
    assert dict(items.dtypes)["order_item_id"] == "int"
    assert dict(items.dtypes)["shipping_limit_date"] == "string"
    orders = read_source(spark, "orders", registry)
    assert dict(orders.dtypes)["order_purchase_timestamp"] == "timestamp_ntz"
    first = orders.where("order_id = 'o1'").first()
    assert first.order_purchase_timestamp == dt.datetime(2018, 1, 1, 23, 59)
    assert orders.where("order_id = 'o2'").first().order_delivered_customer_date is None


def test_bom_header_is_stripped(spark, registry):
    df = read_source(spark, "product_category_translation", registry)
    assert df.columns == ["product_category_name", "product_category_name_english"]
    assert rows(df) == [("beleza_saude", "health_beauty"), ("esporte_lazer", "sports_leisure")]


def test_multiline_review_text_stays_whole(spark, registry):
    df = read_source(spark, "order_reviews", registry)
    assert df.count() == 6
    r1 = df.where("review_id = 'r1'").first()
    assert r1.review_comment_message == 'Great, fast "really" good\nsecond line '
    assert df.where("review_id = 'r2'").first().review_score == " 4 "


def test_bad_amount_text_fails_the_ingest(spark, workdir):
    landing = write_landing(
        os.path.join(workdir, "bad"),
        {"order_payments": "order_id,payment_type,payment_installments,payment_value\no1,boleto,1,abc\n"},
    )
    df = read_source(spark, "order_payments", Registry(landing_root=landing))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.collect()


def test_missing_declared_column_raises(spark, workdir):
    landing = write_landing(os.path.join(workdir, "short"), {"sellers": "seller_id,seller_city\ns1,rio\n"})
    with pytest.raises(KeyError, match="seller_zip_code_prefix"):
        read_source(spark, "sellers", Registry(landing_root=landing))


def test_csv_round_trip_keeps_text_and_types(spark, workdir):
    src = spark.createDataFrame(
        [(1, "  padded ", 'quote "x", and\nnewline', 1.25, dt.datetime(2020, 2, 29, 23, 59, 1))],
        "id bigint, a string, b string, x double, t timestamp_ntz",
    )
    path = os.path.join(workdir, "rt")
    write_csv(src, path)
    back = read_csv(spark, path, schema=src.schema, multiline=True)
    assert back.collect() == src.collect()


@pytest.mark.parametrize("multiline", [False, True])
def test_csv_round_trip_quotes_and_empty_text(spark, workdir, multiline):
    src = spark.createDataFrame(
        [(1, 'say "hi", x', ""), (2, "a,b", None), (None, "\\N-like \\ slash", " "), (4, "\\N", "NULL")],
        "id bigint, a string, b string",
    )
    path = os.path.join(workdir, "rt")
    write_csv(src, path)
    back = read_csv(spark, path, schema=src.schema, multiline=multiline)
    assert sorted(back.collect(), key=str) == sorted(src.collect(), key=str)


def test_layer_write_read_path_layout(spark, registry, workdir):
    wh = Warehouse(registry=registry, root=os.path.join(workdir, "wh"))
    df = read_source(spark, "sellers", registry)
    where = write_layer(df, "sellers", "bronze", wh)
    assert where.endswith("/bronze/bronze_sellers")
    assert rows(read_layer(spark, "sellers", "bronze", wh)) == rows(df)
    write_layer(df.limit(1), "sellers", "bronze", wh)  # overwrite, not append
    assert read_layer(spark, "sellers", "bronze", wh).count() == 1


def test_layer_write_read_catalog_layout(spark, registry):
    wh = Warehouse(registry=registry)
    df = read_source(spark, "product_category_translation", registry)
    assert write_layer(df, "product_category_translation", "bronze", wh) == (
        "bronze.bronze_product_category_translation"
    )
    assert rows(read_layer(spark, "product_category_translation", "bronze", wh)) == rows(df)


def test_every_source_has_a_schema_and_file():
    from emporia.sources import SOURCE_FILES

    assert set(SOURCE_SCHEMAS) == set(SOURCE_FILES)


# --- read options and inferred types of undeclared columns -------------------------

MIXED = (
    "seller_id,since,seller_zip_code_prefix,rating,seller_city,active,seller_state,n,note\n"
    "s1,2018-01-02 03:04:05,01151,4.5,Rio,true,RJ,7,\n"
    "s2,2019-01-02 03:04:05,20000,3,Niteroi,false,RJ,,x\n"
)


def test_undeclared_columns_get_the_readers_types_on_request(spark, workdir):
    landing = write_landing(os.path.join(workdir, "mixed"), {"sellers": MIXED})
    plain = read_source(spark, "sellers", Registry(landing_root=landing))
    assert {t for _, t in plain.dtypes} == {"string"}
    registry = Registry(landing_root=landing, infer_undeclared=frozenset({"sellers"}))
    df = read_source(spark, "sellers", registry)
    inferred = dict(
        spark.read.csv(registry.source_path("sellers"), header=True, inferSchema=True).dtypes
    )
    declared = set(SOURCE_SCHEMAS["sellers"].fieldNames())
    assert {c: t for c, t in df.dtypes if c not in declared} == {c: t for c, t in inferred.items() if c not in declared}
    assert dict(df.dtypes)["rating"] == "double" and dict(df.dtypes)["n"] == "int"
    # a declared column keeps its declared type and its leading zero
    assert inferred["seller_zip_code_prefix"] == "int"
    assert sorted(r.seller_zip_code_prefix for r in df.collect()) == ["01151", "20000"]
    assert sorted((r.seller_id, r.rating, r.active, r.n, r.note) for r in df.collect()) == [
        ("s1", 4.5, True, 7, None), ("s2", 3.0, False, None, "x")]


def test_no_inference_pass_where_every_column_is_declared(spark, registry, monkeypatch):
    from emporia.sources import landing

    asked = []
    reader = landing._reader
    monkeypatch.setattr(landing, "_reader", lambda *a: asked.append(1) or reader(*a))
    path = registry.source_path("product_category_translation")
    df = read_csv(spark, path, schema=SOURCE_SCHEMAS["product_category_translation"], infer_undeclared=True)
    assert len(asked) == 1 and df.count() == 2


def test_read_options_of_one_dataset(spark, workdir):
    text = "seller_id;seller_zip_code_prefix;seller_city;seller_state\ns1;01151;'São; Paulo\n(centro)';SP\n"
    root = os.path.join(workdir, "options")
    os.makedirs(root)
    with open(os.path.join(root, "olist_sellers_dataset.csv"), "wb") as f:
        f.write(text.encode("iso-8859-1"))
    options = {"sep": ";", "quote": "'", "encoding": "ISO-8859-1", "multiLine": "true"}
    registry = Registry(landing_root=root, options={"sellers": options})
    assert registry.read_options("order_reviews") == {"multiLine": "true"}
    assert [tuple(r) for r in read_source(spark, "sellers", registry).collect()] == [
        ("s1", "01151", "São; Paulo\n(centro)", "SP")]


# --- a landing of part files ---------------------------------------------------------


@pytest.mark.parametrize("entry", ["reviews", "reviews/*.csv"])
def test_review_part_files_are_read_in_parallel(spark, workdir, entry):
    source = spark.range(400).select(
        F.concat(F.lit("r"), F.col("id")).alias("review_id"),
        F.concat(F.lit("o"), F.col("id") % 50).alias("order_id"),
        (F.col("id") % 5 + 1).cast("string").alias("review_score"),
        F.concat(F.lit('first "line", '), F.col("id"), F.lit("\nsecond\n")).alias("review_comment_message"),
    )
    root = os.path.join(workdir, "parts")
    write_csv(source.coalesce(1), f"{root}/reviews", max_records_per_file=100)
    write_csv(source.coalesce(1), f"{root}/whole")
    registry = Registry(landing_root=root, files={"order_reviews": entry})
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # below the size of a part file
        df = read_source(spark, "order_reviews", registry)
        assert df.rdd.getNumPartitions() == 4
        assert read_csv(spark, f"{root}/whole", multiline=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved)
    # small files share a read task (as few tasks as sizes allow)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        packed = read_source(spark, "order_reviews", registry)
        assert packed.rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert rows(packed) == rows(df) == rows(source) == rows(read_csv(spark, f"{root}/whole", multiline=True))


# --- table names and the staged overwrite --------------------------------------------


def test_table_and_database_names_can_be_set():
    registry = Registry(
        catalog="main", databases={"gold": "reporting"}, tables={("gold", "daily_sales"): "sales_by_day"}
    )
    assert registry.table_name("daily_sales", "gold") == "main.reporting.sales_by_day"
    assert registry.table_name("daily_sales", "gold", qualified=False) == "sales_by_day"
    assert registry.table_name("customers", "silver") == "main.silver.silver_customers"


@pytest.fixture()
def own_warehouse(spark, workdir):
    name = f"staged_{uuid.uuid4().hex}"
    yield Warehouse(Registry(databases={"bronze": name}), databases_under=workdir)
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_staged_overwrite_replaces_the_table(spark, own_warehouse):
    first = spark.range(10).toDF("seller_id")
    for frame in (first, first.limit(3), first.limit(0).withColumn("more", F.lit("x"))):
        table = write_layer(frame, "sellers", "bronze", own_warehouse, bucket_by=(2, "seller_id"))
        assert rows(read_layer(spark, "sellers", "bronze", own_warehouse)) == rows(frame)
    assert [t.name for t in spark.catalog.listTables(table.split(".")[0])] == ["bronze_sellers"]


def test_a_failed_run_leaves_the_old_table(spark, own_warehouse, monkeypatch):
    from emporia.sources import tables

    old = spark.range(10).toDF("seller_id")
    table = write_layer(old, "sellers", "bronze", own_warehouse)

    def unchanged():
        assert rows(spark.table(table)) == rows(old)
        assert [t.name for t in spark.catalog.listTables(table.split(".")[0])] == ["bronze_sellers"]

    # the job itself fails while it writes
    bad = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error("broken")).otherwise("x").alias("seller_id"))
    with pytest.raises(Exception, match="broken"):
        write_layer(bad, "sellers", "bronze", own_warehouse)
    unchanged()

    # rows get lost between the job and its table
    save = tables._save
    monkeypatch.setattr(tables, "_save", lambda df, *a: save(df.where(F.rand(1) < 0.5), *a))
    with pytest.raises(RuntimeError, match="rows"):
        write_layer(spark.range(100).toDF("seller_id"), "sellers", "bronze", own_warehouse)
    unchanged()
    monkeypatch.undo()

    # the rename of the new table fails
    class Failing:
        def sql(self, text):
            if f"{tables.STAGING} RENAME" in text:
                raise RuntimeError("catalog lost")
            return spark.sql(text)

        def __getattr__(self, name):
            return getattr(spark, name)

    frame = spark.range(5).toDF("seller_id")
    monkeypatch.setattr(type(frame), "sparkSession", property(lambda self: Failing()))
    with pytest.raises(RuntimeError, match="catalog lost"):
        tables.replace_table(frame, table)
    monkeypatch.undo()
    unchanged()
    write_layer(frame, "sellers", "bronze", own_warehouse)
    assert rows(spark.table(table)) == rows(frame)


def test_a_run_lost_between_renames_is_taken_up(spark, own_warehouse):
    from emporia.sources import tables

    table = write_layer(spark.range(4).toDF("seller_id"), "sellers", "bronze", own_warehouse)
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}{tables.PREVIOUS}")
    bad = spark.range(1).select(F.raise_error("broken").alias("seller_id"))
    with pytest.raises(Exception, match="broken"):
        write_layer(bad, "sellers", "bronze", own_warehouse)
    assert spark.table(table).count() == 4
