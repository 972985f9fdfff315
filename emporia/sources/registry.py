"""Dataset registry: which source files feed which dataset, how they are read, and table names per layer.

Replaces a JSON config file with plain data; a deployment overrides the fields of
``Registry``.

A dataset's landing entry is a file, a folder of part files or a glob. A file with
quoted line breaks cannot be split, so a large dataset of that kind (reviews) is
landed as many part files (``landing.write_csv`` with ``max_records_per_file``):
each is one read task, small ones are packed into a task by size
(``spark.sql.files.maxPartitionBytes``).
"""

from __future__ import annotations

import posixpath
from dataclasses import dataclass, field

from emporia.sources.schemas import GOLD_COLUMNS, SILVER_COLUMNS, SOURCE_SCHEMAS

# Landing file name of each source dataset (the public
# Brazilian e-commerce dataset's own file names).
SOURCE_FILES: dict[str, str] = {
    "customers": "olist_customers_dataset.csv",
    "geolocation": "olist_geolocation_dataset.csv",
    "order_items": "olist_order_items_dataset.csv",
    "order_payments": "olist_order_payments_dataset.csv",
    "order_reviews": "olist_order_reviews_dataset.csv",
    "orders": "olist_orders_dataset.csv",
    "products": "olist_products_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
    "product_category_translation": "product_category_name_translation.csv",
}

# Free text with quoted line breaks: read whole records.
MULTILINE_SOURCES = frozenset({"order_reviews"})

LAYERS: dict[str, tuple[str, ...]] = {
    "bronze": tuple(SOURCE_SCHEMAS),
    "silver": tuple(SILVER_COLUMNS),
    "gold": tuple(GOLD_COLUMNS),
}


@dataclass(frozen=True)
class Registry:
    """Where sources land, how they are read and where layer tables live.

    ``landing_root``: folder holding the sources.
    ``catalog``: optional catalog prefix for table names (``catalog.layer.table``).
    ``files``: dataset -> file, folder or glob under the root.
    ``options``: dataset -> reader options (``sep``, ``quote``, ``encoding``, ``multiLine``, ...)
    that win over the defaults.
    ``infer_undeclared``: datasets whose undeclared columns get the reader's inferred
    types (declared ones are always cast by name from their text).
    ``databases``: layer -> database name, in place of the layer's own name.
    ``tables``: (layer, dataset) -> table name, in place of ``<layer>_<dataset>``.
    """

    landing_root: str = "."
    catalog: str | None = None
    files: dict[str, str] = field(default_factory=lambda: dict(SOURCE_FILES))
    options: dict[str, dict[str, str]] = field(default_factory=dict)
    infer_undeclared: frozenset[str] = frozenset()
    databases: dict[str, str] = field(default_factory=dict)
    tables: dict[tuple[str, str], str] = field(default_factory=dict)

    def source_path(self, dataset: str) -> str:
        if dataset not in self.files:
            raise KeyError(f"unknown source dataset {dataset!r}; known: {sorted(self.files)}")
        return posixpath.join(self.landing_root.rstrip("/") + "/", self.files[dataset])

    def read_options(self, dataset: str) -> dict[str, str]:
        """Reader options of a dataset: whole records for free text, then its own."""
        multiline = {"multiLine": "true"} if dataset in MULTILINE_SOURCES else {}
        return {**multiline, **self.options.get(dataset, {})}

    def database(self, layer: str) -> str:
        """``[catalog.]<layer>`` or the layer's own database."""
        name = self.databases.get(layer, layer)
        return f"{self.catalog}.{name}" if self.catalog else name

    def table_name(self, dataset: str, layer: str = "bronze", qualified: bool = True) -> str:
        """``[catalog.]<layer>.<layer>_<dataset>``; unknown layer or dataset raises ``KeyError``."""
        if layer not in LAYERS:
            raise KeyError(f"unknown layer {layer!r}; known: {sorted(LAYERS)}")
        if dataset not in LAYERS[layer]:
            raise KeyError(f"unknown {layer} dataset {dataset!r}; known: {list(LAYERS[layer])}")
        table = self.tables.get((layer, dataset), f"{layer}_{dataset}")
        return f"{self.database(layer)}.{table}" if qualified else table
