"""Scans, sinks and model persistence."""

from errlens.sources.readers import (
    OBSERVATION_SCHEMA, read_csv, read_csv_headerless, read_parquet, read_optional,
    table_from_rows,
)
from errlens.sources.writers import (
    write_predictions, write_csv_headerless, write_single_csv, preview,
)
from errlens.sources.models import save_pipeline, load_pipeline
from errlens.sources.tables import DamagedTable, replace, resolve, vacuum

__all__ = [
    "OBSERVATION_SCHEMA", "read_csv", "read_csv_headerless", "read_parquet",
    "read_optional", "table_from_rows", "write_predictions", "write_csv_headerless",
    "write_single_csv", "preview", "save_pipeline", "load_pipeline",
    "DamagedTable", "replace", "resolve", "vacuum",
]
