"""Bronze ingest: a dataset's landing files become a typed bronze table, unchanged otherwise.

One parameterised job serves all nine source datasets.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from emporia.sources.landing import read_source
from emporia.sources.registry import LAYERS
from emporia.sources.tables import Warehouse, write_layer

BRONZE_DATASETS = LAYERS["bronze"]


def ingest(
    spark: SparkSession,
    dataset: str,
    warehouse: Warehouse | None = None,
    schema: StructType | None = None,
) -> str:
    """Read ``dataset``'s landing files and overwrite its bronze table; returns the table."""
    warehouse = warehouse or Warehouse()
    df = read_source(spark, dataset, warehouse.registry, schema=schema)
    return write_layer(df, dataset, "bronze", warehouse)
