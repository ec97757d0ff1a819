"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squeeze(text: Column) -> Column:
    """Runs of white space become one space; none is left at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def dashed(text: Column) -> Column:
    """Date text with ``-`` instead of ``/``."""
    return F.replace(text, F.lit("/"), F.lit("-"))
