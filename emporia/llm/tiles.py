"""Searches in tiles: a stated set of query rows against all rows, block by chunk.

All rows are dealt into chunks and queries into blocks, both of a bounded number of
rows; each (chunk, block) is one group, so a task holds one tile at a time, and
a lost one is computed again. What a tile finds is a short list for each query.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emporia.llm.common import require

Search = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], pd.DataFrame]


def finite_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v, dims) of rows with an id and a vector without null or non-finite components."""
    require(rows, (id_col, vector_col))
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite).select(
        F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.size(v).alias("dims")
    )


def search(
    vectors: DataFrame, every: int, search_tile: Search, score_type: str, k: int, chunk_rows: int, block_rows: int
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of ``search_tile``'s finds for each row
    of ``vectors`` (vec_id, v, dims) whose vec_id is divisible by ``every``.

    Rows that share a query's id are one query, with the smallest vector. Vectors are
    compared with vectors of as many components.
    """
    queries = vectors.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("v", "dims")).alias("q"))
    queries = queries.select("vec_id", "q.v", "q.dims")
    chunks = max(1, math.ceil(vectors.count() / chunk_rows))
    blocks = max(1, math.ceil(queries.count() / block_rows))

    def dealt(rows: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        return rows.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
        )

    keys = ("dims", "chunk", "block")

    def tile(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or asked.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return search_tile(
            asked["vec_id"].to_numpy(dtype=np.int64),
            np.stack(asked["v"].to_numpy()).astype(np.float64),
            rows["vec_id"].to_numpy(dtype=np.int64),
            np.stack(rows["v"].to_numpy()).astype(np.float64),
        )

    found = (
        dealt(vectors, "chunk", chunks, "block", blocks)
        .groupBy(*keys)
        .cogroup(dealt(queries, "block", blocks, "chunk", chunks).groupBy(*keys))
        .applyInPandas(tile, f"query_id long, vec_id long, score {score_type}")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def shortlist(query_id: int, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` highest scores of one query, ties to smaller ids."""
    order = np.lexsort((ids, -scores))[:k]
    return np.full(len(order), query_id), ids[order], scores[order]


def listed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pd.DataFrame:
    if not parts:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    q, i, s = (np.concatenate(x) for x in zip(*parts, strict=True))
    return pd.DataFrame({"query_id": q, "vec_id": i, "score": s})
