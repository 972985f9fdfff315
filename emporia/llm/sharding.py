"""Sharding by extendible hashing: split only the buckets that are too large.

A document's hash is a string of bits (md5 of its id). The directory starts with
the empty prefix; a bucket over the byte limit is split on its next bit, and
only such a bucket, so shards differ in depth and every shard fits the limit. A
document larger than the limit ends alone in a shard.

The directory is built from byte counts, not by moving documents: bytes are
summed by prefix, a step of several bits at once, and only documents inside
still oversized prefixes are looked at in the next step. Rows that share an id
(and so all hash bits) go on splitting on bits of their place in the input,
kept in a written table, so a group of equal ids of any size is split too.
Built-in expressions only.

Defined cases: a null text has 0 bytes; a null id hashes like the text "null";
an empty table gives an empty result; ties in the hash split by place; further
columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import require, written

# Bits from the id's hash, then from the row's place.
HASH_BITS = 60
ALL_BITS = 120
STEP_BITS = 8


def _bits(text: Column) -> Column:
    """The first 60 bits of a text's md5, as a bit string."""
    return F.lpad(F.conv(F.substring(F.md5(text), 1, 15), 16, 2), HASH_BITS, "0")


def _place() -> Column:
    return F.concat_ws(":", F.spark_partition_id().cast("string"), F.monotonically_increasing_id().cast("string"))


def directory(keyed: DataFrame, limit: int) -> tuple[list[tuple[int, DataFrame]], DataFrame]:
    """The directory over ``keyed`` (bits, n_bytes).

    Returns the steps, each (depth, written table of ``cell`` prefixes of that
    depth with the ``shard`` they belong to, null while oversized), and the
    shards: shard, depth, shard_bytes, shard_docs.
    """
    total = keyed.agg(F.sum("n_bytes")).first()[0] or 0
    first = max(1, min(20, math.ceil(math.log2(max(1, total / limit))) + 2))
    steps, shards, depth, inside = [], [], 0, keyed
    while depth < ALL_BITS:
        to = min(ALL_BITS, depth + (STEP_BITS if depth else first))
        cells = written(
            inside.groupBy(F.substring("bits", 1, to).alias("cell")).agg(
                F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n")
            ),
            "shard-cells",
        )
        prefixes = (
            cells.select("b", "n", "cell", F.explode(F.sequence(F.lit(depth), F.lit(to))).alias("depth"))
            .groupBy(F.expr("substring(cell, 1, depth)").alias("shard"), "depth")
            .agg(F.sum("b").cast("long").alias("shard_bytes"), F.sum("n").cast("long").alias("shard_docs"))
        )
        fits = (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1) | (F.col("depth") == ALL_BITS)
        prefixes = written(prefixes.withColumn("fits", fits), "shard-prefixes")
        # A leaf fits while its parent does not; the root of a step is known not to fit, but for the first.
        parents = prefixes.where("not fits").select(F.col("shard").alias("p"))
        leaves = prefixes.where("fits").join(
            parents, F.expr("substring(shard, 1, depth - 1)") == F.col("p"), "left_semi"
        ).where(F.col("depth") > depth)
        if depth == 0:
            leaves = leaves.union(prefixes.where("fits and depth = 0"))
        leaves = written(leaves.drop("fits"), "shard-leaves")
        shards.append(leaves)
        depths = [r[0] for r in leaves.select("depth").distinct().collect()]  # at most STEP_BITS + first numbers
        named = cells.select("cell", F.explode(F.array(*[F.substring("cell", 1, d) for d in depths])).alias("shard")) if depths else None
        cell_shard = named.join(leaves.select("shard"), "shard") if named is not None else None
        steps.append((to, written(
            cells.select("cell").join(cell_shard, "cell", "left") if cell_shard is not None
            else cells.select("cell", F.lit(None).cast("string").alias("shard")),
            "shard-step",
        )))
        large = prefixes.where(f"not fits and depth = {to}").select(F.col("shard").alias("p"))
        if large.isEmpty():
            break
        inside = inside.join(large, F.substring("bits", 1, to) == F.col("p"), "left_semi")
        depth = to
    out = shards[0]
    for s in shards[1:]:
        out = out.union(s)
    return steps, out


def _assigned(keyed: DataFrame, steps: list[tuple[int, DataFrame]]) -> DataFrame:
    """``keyed`` (bits, ...) plus shard, by looking up each step's cells; a step's rows are those
    that no step before it has placed."""
    columns = [F.col(f"`{c}`") for c in keyed.columns]
    open_rows, done = keyed, None
    for k, (depth, cells) in enumerate(steps):
        met = open_rows.join(cells.withColumnRenamed("cell", "__cell"), F.substring("bits", 1, depth) == F.col("__cell"))
        part = met.where(F.col("shard").isNotNull()).select(*columns, "shard")
        done = part if done is None else done.union(part)
        if k + 1 < len(steps):
            open_rows = met.where(F.col("shard").isNull()).select(*columns)
    return done


def keyed_documents(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, n_bytes (UTF-8 bytes of the text) and the 120 bits of each row."""
    require(docs, ("doc_id", "text"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return docs.select(
        *more,
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.concat(_bits(key), _bits(_place())).alias("bits"),
    )


def shards(docs: DataFrame, limit: int = 32 << 20) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, shard (bit prefix),
    depth, shard_bytes, shard_docs. Every shard holds at most ``limit`` bytes, or
    one document."""
    keyed = written(keyed_documents(docs), "shard-keys")
    steps, listed = directory(keyed, limit)
    placed = _assigned(keyed, steps).join(listed, "shard")
    return placed.select("doc_id", "n_bytes", "shard", "depth", "shard_bytes", "shard_docs")


def write_shards(docs: DataFrame, path: str, limit: int = 32 << 20) -> str:
    """Write the whole rows of ``docs`` as Parquet under ``path``, a folder and file a shard.

    The folders' column (``shard_prefix``, with more underscores if ``docs`` has that
    name) is ``s`` and the shard's bit prefix; its name is returned. Rows that share an
    id are placed as in ``shards`` as long as two scans of ``docs`` deal its rows alike.
    """
    keyed = written(keyed_documents(docs), "shard-keys")
    steps, _ = directory(keyed, limit)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    placed = _assigned(keyed_documents(docs, row).select("row", "bits"), steps)
    name = "shard_prefix"
    while name in docs.columns:
        name += "_"
    rows = placed.select("row.*", F.concat(F.lit("s"), "shard").alias(name))
    rows.repartition(name).write.partitionBy(name).parquet(path)
    return name


ORACLE = """
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
         right(repeat('0', 60) || bin(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15))::BIGINT), 60) AS bits
  FROM documents),
p AS (
  SELECT substr(bits, 1, n) AS shard, n AS depth, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_docs
  FROM d, range(0, 24) t(n) GROUP BY 1, 2),
f AS (SELECT *, shard_bytes <= {limit} OR shard_docs = 1 AS fits FROM p),
leaf AS (
  SELECT * FROM f WHERE fits AND (depth = 0 OR EXISTS (
    SELECT 1 FROM f g WHERE g.depth = f.depth - 1 AND g.shard = substr(f.shard, 1, f.depth - 1) AND NOT g.fits)))
SELECT d.doc_id, CAST(d.n_bytes AS BIGINT) AS n_bytes, leaf.shard, CAST(leaf.depth AS INTEGER) AS depth,
       leaf.shard_bytes, leaf.shard_docs
FROM d JOIN leaf ON substr(d.bits, 1, leaf.depth) = leaf.shard
"""
