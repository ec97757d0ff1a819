"""States, macro-regions, and which holidays hold where."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import NATIONAL, REGION_MAP, REGIONS
from ..sources import from_rows


def region_map(spark: SparkSession, regions: Mapping[str, Sequence[str]] = REGIONS) -> DataFrame:
    """``(regiao, uf)``, one row per state."""
    return from_rows(spark, [(r, uf) for r, ufs in regions.items() for uf in ufs], REGION_MAP)


def holds_in(ufs: Sequence[str]) -> Column:
    """A holiday of one of these states, or a national one."""
    return F.col("estado").isin([*ufs, NATIONAL])


def is_valid() -> Column:
    """Date, name and state are all known."""
    return F.col("data").isNotNull() & F.col("nome").isNotNull() & F.col("estado").isNotNull()


def with_national(states: DataFrame) -> DataFrame:
    """The map plus, for each region, one row under the national scope.

    With it, "a state of the region, or national" is one equality on the state:
    a national holiday matches each region once, whatever its number of states.
    """
    national = states.select("regiao").distinct().withColumn("uf", F.lit(NATIONAL))
    return states.select("regiao", "uf").unionByName(national)


def holidays_by_region(holidays: DataFrame, states: DataFrame) -> DataFrame:
    """Each holiday once per region it holds in: adds ``regiao``."""
    scopes = with_national(states).withColumnRenamed("uf", "estado")
    return holidays.join(scopes, "estado").select("regiao", *holidays.columns)
