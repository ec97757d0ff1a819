"""File writers."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, replacing the folder."""
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """CSV with a header line."""
    df.write.mode(mode).option("header", True).csv(path)


def _sized(df: DataFrame, by: Sequence[str]) -> DataFrame:
    # Adaptive execution splits the large partitions of this shuffle and joins
    # the small ones: few files per folder, and no task holds a hot folder alone.
    return df.hint("rebalance", *by)


def observed(seen: Observation) -> dict:
    """What was observed during a write that has ended; nothing where Spark found the plan
    to be empty and so never ran the observation."""
    try:
        return seen.get
    except Py4JError:
        return {}


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], *, mode: str = "append"
) -> list[Row]:
    """Returns the partitions that rows went to, gathered during the write itself."""
    seen = Observation()
    watched = df.observe(seen, F.collect_set(F.struct(*by)).alias("parts"))
    _sized(watched, by).write.mode(mode).partitionBy(*by).parquet(path)
    parts = (tuple(part) for part in observed(seen).get("parts", []))
    return [Row(**dict(zip(by, part))) for part in sorted(parts, key=lambda p: [(v is not None, v) for v in p])]


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows for; leave all others.

    The new files are complete before any old folder goes, so ``df`` may read
    the same table.
    """
    (
        _sized(df, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
