"""Readers and writers."""

from ordermart.sources.readers import MissingSource, read_sources, run_sql, split_corrupt
from ordermart.sources.writers import create_if_absent, publish, replace_table

__all__ = [
    "MissingSource",
    "create_if_absent",
    "publish",
    "read_sources",
    "replace_table",
    "run_sql",
    "split_corrupt",
]
