"""Sources, sinks and catalog helpers."""

from .catalog import cache_view, list_files, materialize, register, schema_table
from .readers import CHURN_SCHEMA, read_csv, read_table
from .sinks import load_model, read_metrics, save_model, write_metrics

__all__ = [
    "CHURN_SCHEMA", "cache_view", "list_files", "load_model", "materialize",
    "read_csv", "read_metrics", "read_table", "register",
    "save_model", "schema_table", "write_metrics",
]
