"""The newest state of each holiday, found in the history or kept up load by load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import load_stamp
from ..operators.cleaning import latest_load
from ..operators.upsert import upsert_table
from ..schemas import SILVER
from ..sinks import write_partitioned
from ..sources import read_table, table_exists

NEWEST_KEY = ("data", "estado")
NEWEST_PARTITIONS = ("ano", "mes")

# A row of silver replaces the kept one if its load is newer, or the same: silver corrects rows
# in place. Rows without a load are the oldest, the first name counts among them.
_NEWER = """CASE WHEN target.dt_carga IS NULL AND source.dt_carga IS NULL
  THEN struct(source.nome, source.tipo) <= struct(target.nome, target.tipo)
ELSE target.dt_carga IS NULL OR source.dt_carga >= target.dt_carga END"""


def newest_state(silver: DataFrame) -> DataFrame:
    """The row of the newest load of each holiday, from all of its history."""
    return latest_load(silver, NEWEST_KEY)


def update_newest(
    spark: SparkSession, silver_path: str, newest_path: str, load_ts: dt.datetime, changed: Sequence[Row]
) -> list[Row]:
    """Bring the table of newest states up to date after one load into silver; returns the
    partitions changed.

    Of silver only the partitions ``changed`` (``load_silver``) are read, and of them the rows
    that the load wrote; the table has the columns of silver, and a row for each holiday with
    date and state. A missing table is made from the whole history.
    """
    silver = read_table(spark, silver_path, SILVER).dropna(subset=list(NEWEST_KEY))
    if not table_exists(spark, newest_path):
        return write_partitioned(newest_state(silver), newest_path, NEWEST_PARTITIONS)
    places = [(part.ano, part.mes) for part in changed if part.ano is not None]
    years, months = ([*{p[k] for p in places}] for k in (0, 1))
    written = silver.filter(
        F.col("ano").isin(years) & F.col("mes").isin(months) & (F.col("last_updated") == load_stamp(load_ts))
    )
    return upsert_table(
        newest_state(written),
        newest_path,
        SILVER,
        NEWEST_KEY,
        NEWEST_PARTITIONS,
        partitions_follow_keys=True,
        update_if=_NEWER,
    )
