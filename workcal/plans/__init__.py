"""The holiday lake, layer by layer.

Each layer has a function from DataFrame to DataFrame and one that also reads and
writes. Paths, years and load time are arguments; the session is the caller's.
"""
from .bronze import bronze_rows, to_bronze
from .chain import LakePaths, run_lake
from .gold import create_report_function, create_views, gold_rows, refresh_gold, to_gold, view_name
from .landing import extract, landing_path, landing_rows
from .newest import newest_state, update_newest
from .report import run_report
from .silver import load_silver, silver_rows, to_silver, validated_rows

__all__ = [
    "LakePaths",
    "bronze_rows",
    "create_report_function",
    "create_views",
    "extract",
    "gold_rows",
    "landing_path",
    "landing_rows",
    "load_silver",
    "newest_state",
    "refresh_gold",
    "run_lake",
    "run_report",
    "silver_rows",
    "to_bronze",
    "to_gold",
    "to_silver",
    "update_newest",
    "validated_rows",
    "view_name",
]
