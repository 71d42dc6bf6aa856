"""Readers for raw deliveries and stored tables."""

from carelake.catalog import shard_name
from carelake.sources.readers import (
    discover_tables,
    ensure_columns,
    read_csv_table,
    read_optional,
    read_shards,
    read_table,
    source_file_parts,
)
from carelake.sources.shards import from_shard_layout, read_year_shards
from carelake.sources.tables import Sources

__all__ = [
    "Sources", "discover_tables", "ensure_columns", "from_shard_layout", "read_year_shards", "read_csv_table", "read_optional", "read_shards",
    "read_table", "shard_name", "source_file_parts",
]
