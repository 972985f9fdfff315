"""Sources and sinks: registry, CSV landing files, layer tables, stand-ins."""

from emporia.sources.landing import cast_by_name, read_csv, read_source, write_csv
from emporia.sources.registry import LAYERS, SOURCE_FILES, Registry
from emporia.sources.schemas import GOLD_COLUMNS, SILVER_COLUMNS, SOURCE_SCHEMAS
from emporia.sources.tables import Warehouse, read_layer, write_layer

__all__ = [
    "cast_by_name",
    "read_csv",
    "read_source",
    "write_csv",
    "LAYERS",
    "SOURCE_FILES",
    "Registry",
    "GOLD_COLUMNS",
    "SILVER_COLUMNS",
    "SOURCE_SCHEMAS",
    "Warehouse",
    "read_layer",
    "write_layer",
]
