"""Cleaning, typing, and one row per key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import load_stamp, parse_date
from ..functions.text import dashed, squeeze
from ..schemas import SOURCE_NAME

HOLIDAY_CLEANING: dict[str, Callable[[Column], Column]] = {
    "nome": squeeze,
    "estado": F.upper,
    "tipo": F.initcap,
    "data": dashed,
}


def clean(
    df: DataFrame, spec: Mapping[str, Callable[[Column], Column]] = HOLIDAY_CLEANING
) -> DataFrame:
    """Each column of ``spec`` replaced by its cleaned form, in one projection."""
    return df.withColumns({name: rule(F.col(name)) for name, rule in spec.items()})


def conform(df: DataFrame, load_ts: dt.datetime) -> DataFrame:
    """Typed ``data`` with its ``ano`` and ``mes``, and the audit columns.

    The text of the date stays in ``data_raw``, for rules that must tell a
    missing date from an unreadable one.
    """
    stamp = load_stamp(load_ts)
    return (
        df.withColumn("data_raw", F.col("data"))
        .withColumn("data", parse_date(F.col("data")))
        .withColumns(
            {
                "silver_timestamp": stamp,
                "fonte_dado": F.lit(SOURCE_NAME),
                "ano": F.year("data"),
                "mes": F.month("data"),
                "last_updated": stamp,
            }
        )
    )


def first_per_key(
    df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str | Column]
) -> DataFrame:
    """The first row of each key in the given order (NULL is a key like any other).

    Spark cuts every map task's rows to one per key before the shuffle
    (``WindowGroupLimit``), so a key with a large part of the rows costs its
    reducer one row per map task.
    """
    order = W.partitionBy(*keys).orderBy(*order_by)
    ranked = df.withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def one_per_holiday(df: DataFrame) -> DataFrame:
    """One row per (date, state, load) after cleaning and typing.

    An unreadable date counts as the text it is, so two of them are not one
    holiday. The survivor does not depend on the order rows arrive in.
    """
    day = F.coalesce(F.col("data").cast("string"), F.col("data_raw"))
    return first_per_key(
        df,
        [day, "estado", "dt_carga"],
        [F.desc("dt_processamento"), F.asc("nome"), F.asc("tipo"), F.asc("data_raw")],
    )


def latest_load(df: DataFrame, keys: Sequence[str] = ("data", "estado")) -> DataFrame:
    """The row of the newest load for each key."""
    return first_per_key(df, keys, [F.desc("dt_carga"), F.asc("nome"), F.asc("tipo")])
