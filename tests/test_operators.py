from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from emporia.operators import ALL, MONEY, centroid, dedupe, mean_of, preview, profile
from tests.conftest import rows

ITEMS = [
    # order_id, order_item_id, product_id, price
    ("o1", 1, "p9", 30.0),
    ("o1", 1, "p2", 10.0),  # same key, smaller product -> kept
    ("o1", 1, None, 99.0),  # NULL sorts first -> kept over both above
    ("o1", 2, "p3", 5.0),
    ("o2", 1, "p1", 7.0),
    ("o2", 1, "p1", 7.0),  # identical copy
    (None, 1, "p4", 1.0),  # NULL key is its own group
]


def _items(spark):
    return spark.createDataFrame(ITEMS, "order_id string, order_item_id int, product_id string, price double")


def test_dedupe_keeps_first_in_total_order(spark):
    out = dedupe(_items(spark), ["order_id", "order_item_id"])
    assert rows(out) == [
        ("o1", 1, None, 99.0),
        ("o1", 2, "p3", 5.0),
        ("o2", 1, "p1", 7.0),
        (None, 1, "p4", 1.0),
    ]


def test_dedupe_is_layout_independent(spark):
    base = rows(dedupe(_items(spark), ["order_id", "order_item_id"]))
    for n in (1, 3, 7):
        shuffled = _items(spark).repartition(n).sortWithinPartitions(F.rand(n))
        assert rows(dedupe(shuffled, ["order_id", "order_item_id"])) == base


def test_dedupe_with_explicit_order_and_key_only(spark):
    out = dedupe(_items(spark), ["order_id"], order_by=[F.col("price").desc()])
    assert rows(out, "order_id", "price") == [("o1", 99.0), ("o2", 7.0), (None, 1.0)]
    keys_only = _items(spark).select("order_id")
    assert rows(dedupe(keys_only, ["order_id"])) == [("o1",), ("o2",), (None,)]


def test_centroid_groups_by_padded_zip_and_skips_nulls(spark):
    geo = spark.createDataFrame(
        [
            ("1151", -23.0, -46.0),
            ("01151", -23.5, -46.5),
            ("1151", None, -47.0),
            ("20000", -22.9, -43.2),
            (None, 1.0, 1.0),
        ],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double",
    )
    out = {r[0]: (r[1], r[2]) for r in centroid(geo).collect()}
    assert out["01151"] == (-23.25, -46.5)
    assert out["20000"] == (-22.9, -43.2)
    assert out[None] == (1.0, 1.0)
    assert len(out) == 3


def exact(values):
    """The double nearest to the sum of some finite doubles."""
    return float(sum((Fraction(v) for v in values), Fraction(0)))


def exact_totals(spark, sums, groups, parts=3):
    """Totals of some groups of doubles, merged from partial sums of arbitrary parts."""
    data = [(g, v) for g, values in enumerate(groups) for v in values]
    df = spark.createDataFrame(data, "g int, x double").repartition(parts).sortWithinPartitions(F.rand(parts))
    partial = df.groupBy("g", F.spark_partition_id().alias("p")).agg(sums.sum("x").alias("s"))
    merged = partial.groupBy("g").agg(sums.merged("s").alias("s"))
    return {r.g: r.t for r in merged.select("g", sums.value("s").alias("t")).collect()}


def test_sums_are_rounded_once_in_any_grouping(spark):
    rng = random.Random(1)
    groups = [[0.1, 0.2, 0.3, 1e6 + 0.07, 0.0001], [0.1] * 10, [1e15, 0.25], [1e-11] * 1000, [0.0], [-0.0, 0.0]]
    groups += [[1e17, 1.0, -1e17], [2.0**53, 1.0, 2.0**-60], [2.0**53, 1.0], [2.0**53 + 2, 1.0], [-(2.0**53), -1.0, -(2.0**-90)]]
    for _ in range(60):
        groups.append([rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.randint(-40, 95) for _ in range(rng.randint(1, 30))])
    for parts in (1, 4):
        got = exact_totals(spark, MONEY, groups, parts)
        assert got == {g: exact(values) for g, values in enumerate(groups)}


def test_sums_over_every_double(spark):
    rng = random.Random(2)
    tiny, huge = 5e-324, 1.7976931348623157e308
    groups = [[tiny], [tiny] * 7, [huge, -huge, tiny], [huge, 1.0, -huge, -1.0], [2.0**-1022, -tiny], [1e300, 1e-300, -1e300]]
    for _ in range(40):
        groups.append([rng.choice([-1, 1]) * math.ldexp(rng.random(), rng.randint(-1073, 1015)) for _ in range(rng.randint(1, 20))])
        near = rng.randint(-1070, 1000)
        groups.append([rng.choice([-1, 1]) * math.ldexp(rng.random(), near + rng.randint(0, 9)) for _ in range(rng.randint(1, 20))])
    got = exact_totals(spark, ALL, groups)
    assert got == {g: exact(values) for g, values in enumerate(groups)}
    assert exact_totals(spark, ALL, [[huge, huge], [-huge, -huge]]) == {0: math.inf, 1: -math.inf}


def test_sums_of_nulls_nan_and_infinities(spark):
    inf, nan = math.inf, math.nan
    groups = [[None, None], [None, 2.5], [inf, 1.0], [-inf, inf], [nan, 1.0], [nan, -inf], [-inf, -inf], []]
    for sums in (MONEY, ALL):
        got = exact_totals(spark, sums, groups)
        plain = {g: None if not [v for v in values if v is not None] else sum(v for v in values if v is not None) for g, values in enumerate(groups)}
        assert {g: str(got.get(g)) for g in plain} == {g: str(t) for g, t in plain.items()}


def test_amounts_outside_the_range_raise(spark):
    for bad in (2.0**96, -1e30, 1e-30):
        with pytest.raises(Exception, match="outside the range of exact sums"):
            exact_totals(spark, MONEY, [[bad, 1.0]])
        assert exact_totals(spark, ALL, [[bad, 1.0]]) == {0: bad + 1.0}


def test_repeated_amounts(spark):
    df = spark.createDataFrame([(0.1, 3), (0.2, 1), (None, 5), (1e9, 10**6)], "x double, n long")
    got = df.agg(MONEY.sum("x", times="n").alias("s")).select(MONEY.value("s").alias("t")).first().t
    assert got == exact([0.1] * 3 + [0.2]+ [1e15])


def test_mean_of_matches_avg_and_nulls_on_zero(spark):
    df = spark.createDataFrame([(1, 3), (1, None), (2, None)], "g int, x int")
    out = dict(
        df.groupBy("g").agg(mean_of(F.sum("x"), F.count("x")).alias("m")).collect()
    )
    assert out == {1: 3.0, 2: None}


def test_profile_counts_rows_and_nulls(spark):
    out = profile(_items(spark)).first().asDict()
    assert out["row_count"] == 7
    assert out["column_count"] == 4
    assert out["nulls_order_id"] == 1
    assert out["nulls_product_id"] == 1
    assert out["nulls_price"] == 0
    assert preview(_items(spark), 5).count() == 5
