"""Working days: calendar join, flags, monthly and yearly totals.

There are two forms of the calendar join, with the same answers.

``calendar_join`` gives one row per day and holiday, as a report of the single
days needs it. ``day_counts`` gives one row per day with its number of holidays;
the totals use it, because counting before the join keeps every later step at
(groups x days) rows however many holidays there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import SATURDAY, SUNDAY
from ..schemas import ERROR, NO_HOLIDAYS, SUCCESS
from .regions import is_valid, with_national

_WEEKEND = (SUNDAY, SATURDAY)


def _workday() -> Column:
    return ~F.col("dia_semana").isin(*_WEEKEND)


def calendar_join(spine: DataFrame, holidays: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``spine`` left-joined to the valid ``holidays`` on ``by`` and ``data``.

    Every day stays; a day with several holidays has a row for each. The left
    join is written as matches plus days without any: the match is an inner join,
    so adaptive execution can split a day that holds a large part of the
    holidays, and the second part needs the distinct days only.
    """
    keys = [*by, "data"]
    extra = [c for c in holidays.columns if c not in spine.columns]
    valid = holidays.filter(is_valid()).select(*keys, *extra)
    matched = spine.join(valid, keys).select(*spine.columns, *extra)
    free = spine.join(valid.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(free, allowMissingColumns=True)


def workday_flags(joined: DataFrame) -> DataFrame:
    """Adds ``dia_util`` and ``is_holiday`` (0/1) to the rows of ``calendar_join``."""
    free = F.col("nome").isNull()
    return joined.withColumns(
        {
            "dia_util": (free & _workday()).cast("int"),
            "is_holiday": (~free).cast("int"),
        }
    )


def holiday_counts(holidays: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by.., data, n_feriados)``: number of valid holidays per group and day."""
    return holidays.filter(is_valid()).groupBy(*by, "data").agg(F.count("*").alias("n_feriados"))


def region_holiday_counts(holidays: DataFrame, states: DataFrame) -> DataFrame:
    """``holiday_counts`` by region for holidays given by state or as national.

    Counts per state and day come first (folded on the map side), then the states
    of a region are added up: no holiday is copied per region.
    """
    per_state = holiday_counts(holidays, ["estado"])
    scopes = with_national(states).withColumnRenamed("uf", "estado")
    return (
        per_state.join(scopes, "estado")
        .groupBy("regiao", "data")
        .agg(F.sum("n_feriados").alias("n_feriados"))
    )


def state_holiday_counts(holidays: DataFrame, states: DataFrame) -> DataFrame:
    """The same with every state as a group of its own (``estado``)."""
    alone = states.select(F.col("uf").alias("regiao"), "uf")
    return region_holiday_counts(holidays, alone).withColumnRenamed("regiao", "estado")


def day_counts(spine: DataFrame, counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per group and day: adds ``n_feriados`` and ``dia_util``.

    A day is off for the whole group as soon as one of its states has a holiday.
    """
    joined = spine.join(counts, [*by, "data"], "left")
    n = F.coalesce("n_feriados", F.lit(0).cast("long"))
    return joined.select(
        *spine.columns,
        n.alias("n_feriados"),
        ((n == 0) & _workday()).cast("int").alias("dia_util"),
    )


def _joined_rows() -> Column:
    # A day stands for one row per holiday in the joined form, and for one if it has none.
    return F.sum(F.greatest("n_feriados", F.lit(1).cast("long")))


def monthly_workdays(days: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals per group, year and month.

    ``total_feriados`` and ``total_dias`` count joined rows (two states with a
    holiday on one day count twice) and ``percentual_feriados`` is their quotient
    as a fraction; ``dias_calendario`` and ``dias_com_feriado`` count days.
    """
    return days.groupBy(*by, "ano", "mes").agg(
        F.sum("dia_util").alias("dias_uteis"),
        F.sum("n_feriados").alias("total_feriados"),
        _joined_rows().alias("total_dias"),
        (F.sum("n_feriados") / _joined_rows()).alias("percentual_feriados"),
        F.count("*").alias("dias_calendario"),
        F.count_if(F.col("n_feriados") > 0).alias("dias_com_feriado"),
    )


def region_faults(
    records: DataFrame, states: DataFrame, fault: Column, year: Column | None = None
) -> DataFrame:
    """``(regiao, ano, falha)``: the regions and years whose records hold a fault.

    ``fault`` gives the message of a faulty record and NULL for a good one; written with
    try-expressions (``try_to_date``, ``try_cast``) it names what would else end the job for
    all regions. Several faults give the smallest message. ``year`` is the year that a record
    belongs to, by default its ``ano``; a faulty record without one concerns all years of its
    regions (``ano`` NULL), and one of the national scope all regions.
    """
    per_state = (
        records.select("estado", (F.col("ano") if year is None else year).alias("ano"), fault.alias("falha"))
        .filter("falha IS NOT NULL")
        .groupBy("estado", "ano")
        .agg(F.min("falha").alias("falha"))
    )
    scopes = with_national(states).withColumnRenamed("uf", "estado")
    return per_state.join(scopes, "estado").groupBy("regiao", "ano").agg(F.min("falha").alias("falha"))


def without_faults(rows: DataFrame, faults: DataFrame) -> DataFrame:
    """The rows of the regions and years that ``region_faults`` does not name."""
    dated = faults.filter("ano IS NOT NULL").select("regiao", "ano")
    always = faults.filter("ano IS NULL").select("regiao")
    return rows.join(dated, ["regiao", "ano"], "left_anti").join(always, "regiao", "left_anti").select(*rows.columns)


def with_faults(totals: DataFrame, faults: DataFrame) -> DataFrame:
    """``region_totals`` in which the regions and years named by ``region_faults`` have status
    ERRO, zeros and the fault as message; the others stay as they are."""
    dated = faults.filter("ano IS NOT NULL")
    always = faults.filter("ano IS NULL").select("regiao", F.col("falha").alias("_sempre"))
    joined = totals.join(dated, ["regiao", "ano"], "left").join(always, "regiao", "left")
    message = F.least("falha", "_sempre")
    faulty = message.isNotNull()
    kept = {c: F.when(faulty, F.lit(0)).otherwise(F.col(c)) for c in ("total_holidays", "working_days", "holiday_percentage")}
    kept["processing_status"] = F.when(faulty, ERROR).otherwise(F.col("processing_status"))
    kept["error_message"] = F.coalesce(message, "error_message")
    return joined.select(*(kept[c].alias(c) if c in kept else F.col(c) for c in totals.columns))


def region_totals(
    monthly: DataFrame, by: Sequence[str] = ("regiao",), groups: DataFrame | None = None
) -> DataFrame:
    """Totals per group and year of monthly rows; ``holiday_percentage`` is in percent.

    A group without any valid holiday in the year is reported with status ERRO
    and zeros, and so is a row of ``groups`` (``by.., ano``) that has no monthly
    rows at all; the other groups are not affected by it.
    """
    keys = [*by, "ano"]
    totals = monthly.groupBy(*keys).agg(
        F.sum("total_feriados").alias("total_holidays"),
        F.sum("dias_uteis").alias("working_days"),
        (F.sum("total_feriados") / F.sum("total_dias") * 100).alias("holiday_percentage"),
    )
    if groups is not None:
        totals = groups.select(*keys).join(totals, keys, "left")
    found = F.coalesce(F.col("total_holidays"), F.lit(0)) > 0
    return totals.select(
        *keys,
        *(
            F.when(found, F.col(c)).otherwise(F.lit(0)).alias(c)
            for c in ("total_holidays", "working_days", "holiday_percentage")
        ),
        F.when(found, SUCCESS).otherwise(ERROR).alias("processing_status"),
        F.when(
            ~found, F.concat(F.lit(NO_HOLIDAYS), F.concat_ws("/", *by))
        ).alias("error_message"),
    )


def workday_profile(
    facts: DataFrame,
    days: DataFrame,
    *,
    date: str,
    measures: dict[str, Column],
    by: Sequence[str] = (),
    keep: Sequence[str] = (),
    report: Sequence[str] = ("dia_util",),
) -> DataFrame:
    """Sums of dated facts on working and other days.

    ``measures`` are per-row values; each result is the sum of one of them. Facts
    are summed per group, day and ``keep`` column before they meet the calendar,
    so they are shuffled only as those sums, and one busy day costs no more than
    another. ``report`` names the columns of ``days`` to group the result by.
    """
    groups = [*by, *keep]
    day = F.col(date).cast("date").alias("data")
    daily = facts.select(*groups, day, *(m.alias(n) for n, m in measures.items())).groupBy(
        *groups, "data"
    ).agg(*(F.sum(n).alias(n) for n in measures))
    shown = [c for c in report if c not in groups]
    tagged = daily.join(days.select(*by, "data", *shown), [*by, "data"], "left")
    return tagged.groupBy(*groups, *shown).agg(*(F.sum(n).alias(n) for n in measures))
