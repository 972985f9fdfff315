"""Small helpers shared by the operators: reading tables, written intermediates."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.session import fresh_scratch_path

# Rows of an Arrow batch that are Python values at once.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, read by Spark (the folder may be on any file system Spark knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts lineage: a lost executor costs the tasks it ran, not the stages before
    the table. The path is fresh, so a rerun never meets older files.
    """
    spark = df.sparkSession
    path = fresh_scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Slots:
    """Written tables of a loop, in a few paths that are used again in turn.

    A table lasts until ``keep`` more were written, so a loop of any length holds
    that many on disk. Write a table only when none older than that is needed.
    """

    def __init__(self, spark: SparkSession, label: str, keep: int = 2) -> None:
        self.spark, self.keep, self.count = spark, keep, 0
        self.root = fresh_scratch_path(spark, label)

    def written(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.count % self.keep}"
        self.count += 1
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def in_slices(*columns: pa.Array, rows: int = SLICE_ROWS) -> Iterator[tuple]:
    """The rows of an Arrow batch's columns as Python values, made for ``rows`` of them at a time: a worker
    never holds a whole batch of texts twice."""
    for at in range(0, len(columns[0]), rows):
        yield from zip(*[c.slice(at, rows).to_pylist() for c in columns], strict=True)


def give_back() -> None:
    """Arrow keeps the memory of batches it has read; the system gets it back, for a worker that waits needs none."""
    pa.default_memory_pool().release_unused()


def require(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns not in frame: {missing}")


def text_or_empty(col: str = "text") -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))
