"""Approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner product becomes nearest point by one more component: vectors are
scaled and filled up to norm one, queries scaled to norm one. Vectors are scaled by
the largest norm of their norm range (norms within a factor of RANGE), so a long
vector does not move the others. Each of TABLES tables hashes by HASHES p-stable
(normal) projections, shifted and cut into cells of WIDTH; a cell of a range is a bucket.

1. Index: every row is hashed once into a bucket of each table; the written table
   of (bucket, row) is all that searches read. A bucket of more than BUCKET_ROWS
   rows is split into salted parts.
2. Probes: every query is hashed once and lists, for each table and range, the
   PROBES buckets with the least estimated distance (squared distances to the
   borders crossed), nearest first. Queries and rows meet by a join on the bucket:
   buckets and their probing queries are packed into shards of about SHARD_ROWS
   rows and ASKED_ROWS queries, and in a shard each bucket's rows are multiplied
   with its own queries only.
3. The FIRST nearest buckets are visited first. Their k-th best score bounds what
   the others have to report: of those only better rows leave a shard, so the
   short lists grow with the queries, not with queries times shards.
4. Candidates of all tables are merged (a row found twice counts once) and ranked by
   the exact inner product of the original vectors in double precision.
5. A query that ends with fewer than ``k`` rows is compared with all rows.

Nearest rows at an inner product of 0.4 leave hashing little to cut off: at these
settings about three quarters of the rows of random directions become candidates.
Recall against brute force is measured in the tests.

Defined cases: null, zero and non-finite vectors take no part; repeated rows are
candidates each; ties go to the smaller vec_id; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emporia.llm import tiles
from emporia.llm.common import written

TABLES, HASHES, WIDTH, PROBES, FIRST = 4, 6, 1.6, 280, 4
# Largest over smallest norm of a range.
RANGE = 1.25
BUCKET_ROWS, SHARD_ROWS, ASKED_ROWS = 2048, 8192, 8192
SEED = 7


class Hashing:
    """The tables' hash functions for vectors of ``dims`` components."""

    def __init__(self, dims: int, tops: np.ndarray) -> None:
        """``tops``: the largest norm of each norm range, ascending."""
        rng = np.random.default_rng((SEED, dims))
        self.tops = tops
        self.axes = rng.normal(size=(TABLES, dims + 1, HASHES))
        self.shifts = rng.random((TABLES, HASHES))
        # Odd factors that mix range, table and cells to a bucket's number (modulo 2**64).
        self.mixers = rng.integers(1, 2**62, HASHES + 2, dtype=np.int64) | 1
        # All moves of the projections by one cell down, none, or one up.
        self.moves = np.array(list(itertools.product((-1, 0, 1), repeat=HASHES)), dtype=np.int64)

    def ranges(self, rows: np.ndarray) -> np.ndarray:
        """The norm range of each row; sums in another order may pass a range's largest norm by a little."""
        norms = np.linalg.norm(rows, axis=1) * (1 - 1e-9)
        return np.minimum(np.searchsorted(self.tops, norms), len(self.tops) - 1)

    def _buckets(self, table: int, ranges: np.ndarray, cells: np.ndarray) -> np.ndarray:
        return (cells * self.mixers[:HASHES]).sum(axis=-1) + ranges * self.mixers[HASHES] + table * self.mixers[HASHES + 1]

    def buckets(self, rows: np.ndarray) -> np.ndarray:
        """The bucket of each row in each table (rows, TABLES)."""
        ranges = self.ranges(rows)
        scaled = rows / self.tops[ranges][:, None]
        points = np.column_stack([scaled, np.sqrt(np.maximum(0.0, 1 - (scaled * scaled).sum(axis=1)))])
        cells = [np.floor(points @ self.axes[t] / WIDTH + self.shifts[t]).astype(np.int64) for t in range(TABLES)]
        return np.stack([self._buckets(t, ranges, c) for t, c in enumerate(cells)], axis=1)

    def probes(self, queries: np.ndarray, n: int = PROBES) -> np.ndarray:
        """Buckets (queries, TABLES * ranges, n) in order of estimated success."""
        units = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        points = np.column_stack([units, np.zeros(len(units))])
        down, up = (self.moves == -1).astype(float), (self.moves == 1).astype(float)
        out = []
        for table in range(TABLES):
            at = points @ self.axes[table] / WIDTH + self.shifts[table]
            own = np.floor(at)
            inside = at - own
            cost = (inside**2) @ down.T + ((1 - inside) ** 2) @ up.T
            order = np.argsort(cost, axis=1, kind="stable")[:, :n]
            cells = own.astype(np.int64)[:, None, :] + self.moves[order]
            out += [self._buckets(table, np.int64(r), cells) for r in range(len(self.tops))]
        return np.stack(out, axis=1)


def _of_dims(batch: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame, np.ndarray]]:
    for dims, part in batch.groupby("dims"):
        yield int(dims), part, np.stack(part["v"].to_numpy()).astype(np.float64)


def _indexed(tops: np.ndarray) -> Callable:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dims, part, vectors in _of_dims(batch):
                buckets = Hashing(dims, tops).buckets(vectors)
                for table in range(TABLES):
                    yield part.assign(table=table, bucket=buckets[:, table])

    return rows


def _probing(tops: np.ndarray) -> Callable:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dims, part, vectors in _of_dims(batch):
                buckets = Hashing(dims, tops).probes(vectors)
                n, lists, each = buckets.shape
                ids = np.repeat(part["vec_id"].to_numpy(), lists * each)
                first = np.tile(np.arange(each) < FIRST, n * lists)
                yield pd.DataFrame({"query_id": ids, "dims": dims, "bucket": buckets.ravel(), "first": first})

    return rows


FOUND = "query_id long, row long, vec_id long, score double"


def _meet(k: int) -> Callable:
    def meet(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        """Per query its ``k`` best rows of this shard that pass its bound."""
        if rows.empty or asked.empty:
            return pd.DataFrame()
        order = np.argsort(rows["part"].to_numpy(), kind="stable")
        parts, start = np.unique(rows["part"].to_numpy()[order], return_index=True)
        end = np.append(start[1:], len(order))
        vectors = np.stack(rows["v"].to_numpy()).astype(np.float64)[order]
        ids, numbers = rows["vec_id"].to_numpy()[order], rows["row"].to_numpy()[order]
        queries = np.stack(asked["v"].to_numpy()).astype(np.float64)
        own, bound = asked["query_id"].to_numpy(), asked["bound"].fillna(-np.inf).to_numpy(np.float64)
        probed = [np.asarray(p, np.int64) for p in asked["parts"]]
        probe = np.concatenate(probed)
        asking = np.repeat(np.arange(len(asked)), [len(p) for p in probed])
        place = np.searchsorted(parts, probe)
        there = (place < len(parts)) & (parts[np.minimum(place, len(parts) - 1)] == probe)
        place, asking = place[there], asking[there]
        by_part = np.argsort(place, kind="stable")
        place, asking = place[by_part], asking[by_part]
        met, edge = np.unique(place, return_index=True)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for part, a, b in zip(met, edge, np.append(edge[1:], len(place))):
            who, low, high = asking[a:b], start[part], end[part]
            quick = queries[who] @ vectors[low:high].T
            # A quick product sorts out; what is left gets sums in one fixed order, so that ties are ties.
            slack = 1e-9 * np.maximum(1.0, np.abs(quick).max(axis=1, initial=0.0))
            quick[own[who][:, None] == ids[low:high]] = -np.inf
            least = bound[who]
            if high - low > k:
                least = np.maximum(least, np.partition(quick, high - low - k - 1, axis=1)[:, high - low - k - 1])
            q, r = np.nonzero(quick >= (least - slack)[:, None])
            found.append((who[q], low + r))
        if not found:
            return pd.DataFrame()
        q, r = (np.concatenate(x) for x in zip(*found, strict=True))
        keep = own[q] != ids[r]
        q, r = q[keep], r[keep]
        score = np.empty(len(q))
        for at in range(0, len(q), 1 << 18):
            block = slice(at, at + (1 << 18))
            score[block] = (vectors[r[block]] * queries[q[block]]).sum(axis=1)
        best = np.lexsort((numbers[r], ids[r], -score, q))
        q, r, score = q[best], r[best], score[best]
        # Rank within a query, equal rows counted once (a shard holds buckets of several tables).
        fresh = np.ones(len(q), bool)
        fresh[1:] = (q[1:] != q[:-1]) | (numbers[r[1:]] != numbers[r[:-1]])
        q, r, score = q[fresh], r[fresh], score[fresh]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        q, r, score = q[rank < k], r[rank < k], score[rank < k]
        if not len(q):
            return pd.DataFrame()
        return pd.DataFrame({"query_id": own[q], "row": numbers[r], "vec_id": ids[r], "score": score})

    return meet


def _met(index: DataFrame, asked: DataFrame, k: int, blocks: int) -> DataFrame:
    """``FOUND`` rows of shards (dims, shard) of the index and the queries that probe them."""
    keys = ("dims", "shard", "asking")
    asked = asked.withColumn("asking", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    index = index.withColumn("asking", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(_meet(k), FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query, a row found several times counted once; ``place`` from 1."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"), F.asc("row"))
    single = found.groupBy("query_id", "row").agg(F.first("vec_id").alias("vec_id"), F.first("score").alias("score"))
    return single.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for each row whose id is
    divisible by ``every``, its own id left out. Rows that share a query's id are one
    query, with the smallest vector."""
    usable = tiles.finite_vectors(vectors, id_col, vector_col).where(F.exists("v", lambda x: x != 0))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    norm = F.sqrt(square).alias("norm")
    ranged = usable.select(norm).groupBy(F.round(F.log("norm") / math.log(RANGE)).alias("range"))
    tops_found = ranged.agg(F.max("norm").alias("top")).where("top > 0").collect()  # a row for each range
    tops = np.sort([r.top for r in tops_found]) if tops_found else np.ones(1)

    kind = vectors.schema[vector_col].dataType.simpleString()
    numbered = usable.withColumn("row", F.monotonically_increasing_id())
    hashed = numbered.mapInPandas(
        _indexed(tops), f"vec_id bigint, v {kind}, dims int, row bigint, `table` int, bucket bigint"
    )
    hashed = written(hashed, "lsh-rows")
    queries = vectors_of_queries(hashed.where(F.col("table") == 0), every)
    queries = written(queries, "lsh-queries")

    shards = max(1, math.ceil(hashed.count() / SHARD_ROWS))
    blocks = max(1, math.ceil(queries.count() / ASKED_ROWS))
    full = hashed.groupBy("dims", "bucket").agg(F.ceil(F.count(F.lit(1)) / BUCKET_ROWS).cast("int").alias("salts"))
    full = written(full.where("salts > 1"), "lsh-full-buckets")

    def part(salt: Column) -> Column:
        return F.xxhash64("bucket", salt)

    def shard_of(frame: DataFrame) -> DataFrame:
        return frame.withColumn("shard", F.pmod("part", F.lit(shards)).cast("int"))

    salted = hashed.join(full, ["dims", "bucket"], "left").withColumn(
        "part", part(F.coalesce(F.pmod(F.xxhash64("row"), F.col("salts")), F.lit(0)).cast("int"))
    )
    index = shard_of(salted).select("dims", "shard", "part", "row", "vec_id", "v")
    probes = queries.mapInPandas(_probing(tops), "query_id bigint, dims int, bucket bigint, first boolean")
    probes = probes.join(full, ["dims", "bucket"], "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    )
    probes = shard_of(probes.withColumn("part", part(F.col("salt"))))
    listed = probes.groupBy("dims", "shard", "query_id", "first").agg(F.collect_list("part").alias("parts"))
    listed = written(listed, "lsh-probes")
    of_query = queries.select(F.col("vec_id").alias("query_id"), "v")

    def asked(first: bool) -> DataFrame:
        return listed.where(F.col("first") == first).join(of_query, "query_id")

    unbounded = F.lit(None).cast("double").alias("bound")
    near = written(_met(index, asked(True).withColumn("bound", unbounded), k, blocks), "lsh-near")
    bounds = _best(near, k).where(F.col("place") == k).select("query_id", F.col("score").alias("bound"))
    far = _met(index, asked(False).join(bounds, "query_id", "left"), k, blocks)
    best = written(_best(near.unionByName(far), k), "lsh-best")

    # Queries short of k rows meet all rows of the first table.
    counted = of_query.join(best.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")), "query_id", "left")
    short = counted.where(F.coalesce("n", F.lit(0)) < k).select("query_id", "v")
    short = written(short.join(queries.select(F.col("vec_id").alias("query_id"), "dims"), "query_id"), "lsh-short")
    if not short.isEmpty():
        one = F.lit(0).cast("long")
        rows = hashed.where(F.col("table") == 0).withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
        everywhere = short.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).select(
            "*", F.array(one).alias("parts"), unbounded
        )
        all_rows = _met(rows.select("dims", "shard", one.alias("part"), "row", "vec_id", "v"), everywhere, k, blocks)
        rest = best.join(short.select("query_id"), "query_id", "left_anti")
        best = rest.unionByName(_best(all_rows, k).select(*rest.columns))
    return best.select("query_id", F.col("place").alias("rank"), "vec_id", "score")


def vectors_of_queries(rows: DataFrame, every: int) -> DataFrame:
    """(vec_id, v, dims): one query an id divisible by ``every``, the smallest vector of its rows."""
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("v", "dims")).alias("q"))
    return asked.select("vec_id", "q.v", "q.dims")
