"""Equi-joins that stay balanced when one key holds a large share of the rows.

A sort-merge join sends every row of a key to one task. AQE repairs that from the
sizes it measures: a partition far above the others is split over several tasks
(``spark.sql.adaptive.skewJoin.*``), whichever keys fill it, and nothing is paid
where no partition stands out. It can do so only if *both* inputs of the join
arrive straight from the join's own shuffle. An aggregate or a deduplicated table
reaches a join already partitioned on the key, so no shuffle sits below the join
and a hot key would stay whole in one task.

``balanced_join`` gives such a join its own shuffle on both sides: it joins on the
key and on a hash of the key. Equal keys have equal hashes, so the result is that of
the plain join, but a partitioning on the key alone does not serve two join keys
(``spark.sql.requireAllClusterKeysForCoPartition``, on by default). A side that had
to be shuffled anyway is shuffled as before; the cost is one more shuffle of the
side that was already partitioned, which is an aggregate or deduplicated table and
so the smaller one. No rows are counted, no list of keys is kept, and there is no
limit to the number of hot keys.

NULL keys of a left join never match but are kept, and hashing sends them all to one
partition. They are rows of the left side, which AQE splits like any other.

Whether the other side is broadcast is left to AQE's measurement of it
(``spark.sql.adaptive.autoBroadcastJoinThreshold``); there is no hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: session setting; "false" makes every balanced join a plain one (say,
# for tables bucketed on the key, whose buckets a join's own shuffle would undo).
SPLIT_CONF = "emporia.skew.split"

_SPREAD = "__spread"


def splits_hot_keys(spark: SparkSession) -> bool:
    """Whether the session wants joins that AQE can split (``emporia.skew.split``)."""
    return spark.conf.get(SPLIT_CONF, "true").lower() != "false"


def balanced_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner", split: bool | None = None) -> DataFrame:
    """``big.join(small, key, how)`` (``inner`` or ``left``) that AQE can split.

    Output columns: ``key``, then ``big``'s other columns, then ``small``'s other
    columns (the layout of a join on a column name). ``small`` should hold few
    rows per key: a split reads its rows of the partition once per part.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"balanced_join supports inner and left joins, not {how!r}")
    clash = (set(big.columns) & set(small.columns)) - {key}
    if clash:
        raise ValueError(f"columns on both sides besides the key: {sorted(clash)}")
    if not (splits_hot_keys(big.sparkSession) if split is None else split):
        return big.join(small, key, how)
    spread = F.xxhash64(F.col(f"`{key}`"))
    joined = big.withColumn(_SPREAD, spread).join(small.withColumn(_SPREAD, spread), [key, _SPREAD], how)
    return joined.drop(_SPREAD)
