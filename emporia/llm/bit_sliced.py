"""Exact top-k inner products by a bit-sliced index.

Components are whole numbers, floor(scale * x). In a tile of rows each dimension
is kept as bitmaps, one for each of its highest SLICES bits (after taking off the
dimension's minimum). A query adds the slices of all dimensions, each as often as
its weight's bits say, with carry-save adders on whole bitmaps; a negative weight
adds the complements. The sum is again a list of bitmaps. The k-th largest sum is
found from its most significant slice downward. The bits that were left out
can move a row's sum by a known bound at most, so rows down to the k-th sum less
that bound are the boundary; these alone get their exact integer scores.

Defined cases: null, empty and non-finite vectors take no part; repeated rows are
candidates each; ties go to the smaller vec_id; an empty table gives an empty
result; further columns are not read. Scores must fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from emporia.llm import tiles

SCALE = 1024
SLICES = 8
CHUNK_ROWS, BLOCK_ROWS = 4096, 128


def bitmaps(flags: np.ndarray) -> np.ndarray:
    """Rows of flags (..., n) packed into 64-bit words."""
    n = flags.shape[-1]
    padded = np.zeros((*flags.shape[:-1], -(-n // 64) * 64), np.uint8)
    padded[..., :n] = flags
    return np.packbits(padded, axis=-1, bitorder="little").view(np.uint64)


def rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def add_slices(levels: dict[int, list[np.ndarray]], words: int) -> list[np.ndarray]:
    """The sum of bitmaps by weight 2**level, as slices (lowest first)."""
    out, level = [], 0
    while any(at >= level for at in levels):
        stack = levels.pop(level, [])
        maps = np.concatenate(stack) if stack else np.empty((0, words), np.uint64)
        while len(maps) > 1:
            if len(maps) == 2:  # a half adder
                carry, left = (maps[0] & maps[1])[None], (maps[0] ^ maps[1])[None]
            else:  # full adders on all triples at once
                m = len(maps) // 3
                a, b, c = maps[:m], maps[m : 2 * m], maps[2 * m : 3 * m]
                half = a ^ b
                carry, left = (a & b) | (half & c), np.concatenate([half ^ c, maps[3 * m :]])
            levels.setdefault(level + 1, []).append(carry)
            maps = left
        out.append(maps[0] if len(maps) else np.zeros(words, np.uint64))
        level += 1
    return out


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def kth_largest(slices: list[np.ndarray], rows: np.ndarray, k: int) -> int:
    """The k-th largest sum among ``rows`` (0 if there are fewer)."""
    value, above, equal = 0, np.zeros_like(rows), rows
    for level in range(len(slices) - 1, -1, -1):
        ones = equal & slices[level]
        if _count(above) + _count(ones) >= k:
            value, equal = value | 1 << level, ones
        else:
            above, equal = above | ones, equal & ~slices[level]
    return value


def at_least(slices: list[np.ndarray], rows: np.ndarray, value: int) -> np.ndarray:
    """Those of ``rows`` whose sum is ``value`` or more."""
    if value <= 0:
        return rows
    above, equal = np.zeros_like(rows), rows
    for level in range(max(len(slices), value.bit_length()) - 1, -1, -1):
        ones = slices[level] if level < len(slices) else np.zeros_like(rows)
        if value >> level & 1:
            equal = equal & ones
        else:
            above, equal = above | (equal & ones), equal & ~ones
    return above | equal


class Index:
    """The slices of one tile's whole-number vectors (rows, dims)."""

    def __init__(self, numbers: np.ndarray) -> None:
        self.numbers, (n, dims) = numbers, numbers.shape
        offset = numbers - numbers.min(axis=0)
        self.shift = max(0, int(offset.max()).bit_length() - SLICES)
        high = (offset >> self.shift).T
        self.all = bitmaps(np.ones(n, np.uint8))
        self.slices = [bitmaps((high >> b & 1).astype(np.uint8)) for b in range(SLICES)]

    def boundary(self, query: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
        """Rows among which the ``k`` highest scores are."""
        if _count(rows) <= k:
            return rows_of(rows)
        weight = np.abs(query)
        levels: dict[int, list[np.ndarray]] = {}
        for bit in range(int(weight.max()).bit_length()):
            for sign in (query > 0, query < 0):
                at = np.flatnonzero((weight >> bit & 1).astype(bool) & sign)
                if len(at):
                    for b, maps in enumerate(self.slices):
                        part = maps[at]
                        levels.setdefault(bit + b, []).append(part if query[at[0]] > 0 else ~part)
        sums = add_slices(levels, len(self.all))
        kth = kth_largest(sums, rows, k)
        bound = int(weight.sum()) if self.shift else 0
        return rows_of(at_least(sums, rows, kth - bound))


def whole_numbers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    return np.floor(scale * vectors).astype(np.int64)


def top_k(vectors: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows with the highest integer inner product
    for each row whose id is divisible by ``every``, its own id left out."""

    def tile(asked_ids: np.ndarray, asked: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> pd.DataFrame:
        index, queries, out = Index(whole_numbers(rows)), whole_numbers(asked), []
        for query_id, query in zip(asked_ids, queries, strict=True):
            at = index.boundary(query, index.all & ~bitmaps((ids == query_id).astype(np.uint8)), k)
            out.append(tiles.shortlist(query_id, ids[at], index.numbers[at] @ query, k))
        return tiles.listed(out)

    usable = tiles.finite_vectors(vectors, id_col, vector_col)
    return tiles.search(usable, every, tile, "long", k, CHUNK_ROWS, BLOCK_ROWS)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_sum(list_transform(list_zip(q.c, v.c), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id AND len(q.c) = len(v.c))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s QUALIFY rank <= 10
"""
