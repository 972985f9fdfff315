"""Repeatable key deduplication.

``dropDuplicates(keys)`` keeps an arbitrary row per key: the row kept depends on
partition layout, and a recomputed stage after an executor loss may keep a
different one than its first attempt did. Here the survivor is the first row in
a total order over every non-key column, so every run and every task retry
returns the same rows.

Plan shape: one exchange on the keys, ``Sort`` + ``Window`` + ``Filter``.
Catalyst inserts a map-side ``WindowGroupLimit`` before the exchange, so each
map task ships at most one row per key: a key holding a third of all rows is
cut down to one row per map task before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__dedupe_rank"


def dedupe(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keep one row per ``keys``.

    ``order_by`` defaults to every other column ascending, NULLs first; ties on
    all of them are identical rows, so which one survives does not matter.
    """
    keys = list(keys)
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise KeyError(f"dedupe keys not in frame: {missing}")
    if order_by is None:
        order_by = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    order = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]
    if not order:
        # Only key columns: plain distinct (hash aggregate with map-side combine).
        return df.dropDuplicates(keys)
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(_RANK, F.row_number().over(window))
        .where(F.col(_RANK) == 1)
        .drop(_RANK)
    )
