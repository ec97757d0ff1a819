"""Writers."""
from .files import (
    observed,
    overwrite_partitions,
    write_csv,
    write_json,
    write_partitioned,
)

__all__ = [
    "observed",
    "overwrite_partitions",
    "write_csv",
    "write_json",
    "write_partitioned",
]
