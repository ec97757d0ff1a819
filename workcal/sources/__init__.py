"""Readers and generated tables."""
from .files import (
    from_rows,
    in_partitions,
    json_columns_seen,
    missing_json_columns,
    read_csv,
    read_json_lines,
    read_table,
    table_exists,
)
from .spine import date_spine, group_spine

__all__ = [
    "date_spine",
    "from_rows",
    "group_spine",
    "in_partitions",
    "json_columns_seen",
    "missing_json_columns",
    "read_csv",
    "read_json_lines",
    "read_table",
    "table_exists",
]
