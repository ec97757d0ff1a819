"""Date dimension: one row per day, generated, never stored."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import day_of_week


def group_spine(
    groups: DataFrame, first: Column | dt.date, last: Column | dt.date
) -> DataFrame:
    """Every day from ``first`` to ``last`` for each row of ``groups``.

    The days are exploded from the row itself, so nothing is joined or shuffled,
    and ``first``/``last`` may be columns of ``groups``.
    """
    first, last = (F.lit(v) if isinstance(v, dt.date) else v for v in (first, last))
    days = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))
    kept = [c for c in groups.columns]
    return groups.select(*kept, F.explode(days).alias("data")).select(
        *kept,
        "data",
        day_of_week(F.col("data")).alias("dia_semana"),
        F.month("data").alias("mes"),
        F.year("data").alias("ano"),
    )


def date_spine(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """``(data, dia_semana, mes, ano)`` for every day from ``first`` to ``last``."""
    return group_spine(spark.range(1).select(), first, last)
