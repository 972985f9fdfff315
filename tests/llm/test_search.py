"""Both vector searches against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from emporia.llm import bit_sliced, multiprobe


def vectors(spark, n=1200, dims=16, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)).astype(np.float32)
    x[7] = x[3]
    rows = [(i, [float(v) for v in x[i]], "q") for i in range(n)]
    odd = [(5000, None, "q"), (5100, [], "q"), (5200, [None] * dims, "q"), (5300, [float("nan")] * dims, "q"),
           (5400, [float("inf")] * dims, "q"), (None, [1.0] * dims, "q")]
    return x, spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score string")


def test_bit_sliced_is_exact(spark):
    x, df = vectors(spark)
    z = np.floor(1024 * x.astype(np.float64)).astype(np.int64)
    ids = np.arange(len(x))
    got = bit_sliced.top_k(df).toPandas()
    assert set(got.query_id) == set(range(0, len(x), 100))
    for q, rows in got.groupby("query_id"):
        s = z @ z[q]
        s[q] = -(2**60)  # whose negation still fits
        want = np.lexsort((ids, -s))[:10]
        rows = rows.sort_values("rank")
        assert list(rows.vec_id) == list(want) and list(rows.score) == list(s[want])


def test_boundary_holds_the_best_with_few_slices(monkeypatch):
    monkeypatch.setattr(bit_sliced, "SLICES", 3)
    rng = np.random.default_rng(2)
    numbers = rng.integers(-3000, 3000, (500, 8))
    index = bit_sliced.Index(numbers)
    for query in rng.integers(-900, 900, (10, 8)):
        at = index.boundary(query, index.all, 7)
        assert set(np.argsort(-(numbers @ query), kind="stable")[:7]) <= set(at)


def test_multiprobe_recall_scores_and_order(spark):
    x, df = vectors(spark)
    d = x.astype(np.float64)
    got = multiprobe.nearest(df).toPandas()
    assert set(got.query_id) == set(range(0, len(x), 20))
    hits = 0
    for q, rows in got.groupby("query_id"):
        rows = rows.sort_values("rank")
        s = d @ d[q]
        assert q not in set(rows.vec_id) and len(rows) == 20
        assert np.allclose(rows.score, s[rows.vec_id], rtol=1e-12, atol=1e-12)
        assert list(rows.vec_id) == list(rows.sort_values(["score", "vec_id"], ascending=[False, True]).vec_id)
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:20]) & set(rows.vec_id))
    assert hits / len(got) >= 0.9


@pytest.mark.parametrize("stretch", ["one long row", "all unequal"])
def test_multiprobe_recall_with_unequal_norms(spark, stretch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1200, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if stretch == "one long row":
        x[11] *= 100
    else:
        x *= np.exp(rng.normal(size=(1200, 1)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = multiprobe.nearest(df).toPandas()
    assert set(got.query_id) == set(range(0, 1200, 20)) and len(got) == 60 * 20
    hits = 0
    for q, rows in got.groupby("query_id"):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:20]) & set(rows.vec_id))
    assert hits / len(got) >= 0.9


def test_multiprobe_gives_all_rows_if_there_are_fewer_than_k(spark):
    x = np.random.default_rng(6).normal(size=(15, 64))
    x[4] *= 50
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = multiprobe.nearest(df, every=1).toPandas()
    for q in range(15):
        rows = got[got.query_id == q].sort_values("rank")
        assert list(rows.vec_id) == [i for i in np.argsort(-(x @ x[q])) if i != q]


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in bit_sliced.top_k(df).collect()] == [(0, 1, 2, 524288), (0, 2, 1, 0)]
    assert {r.vec_id for r in multiprobe.nearest(df).collect()} <= {2}
    for search in (bit_sliced.top_k, multiprobe.nearest):
        assert search(df.limit(0)).count() == 0


def test_repeated_rows_are_candidates_each(spark):
    df = spark.createDataFrame([(0, [1.0, 1.0]), (0, [1.0, 1.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [r.vec_id for r in bit_sliced.top_k(df).orderBy("rank").collect()] == [3, 3]


@pytest.mark.parametrize("n", [1, 63, 64, 65, 200])
def test_bitmap_round_trip(n):
    flags = np.arange(n) % 3 == 0
    assert list(bit_sliced.rows_of(bit_sliced.bitmaps(flags.astype(np.uint8)))) == list(np.flatnonzero(flags))
