"""Silver -> gold: working days and holidays per region and month, one job for all regions."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import load_stamp
from ..operators.upsert import upsert_table
from ..operators.regions import with_national
from ..operators.workdays import (
    day_counts,
    monthly_workdays,
    region_holiday_counts,
    region_totals,
    with_faults,
    without_faults,
)
from ..schemas import GOLD, GOLD_KEY, REPORT_FUNCTION, SILVER, SUCCESS
from ..scratch import stage
from ..sources import group_spine, read_table
from .newest import newest_state

GOLD_PARTITIONS = ("regiao", "ano")


def region_days(
    holidays: DataFrame, states: DataFrame, first_year: int, last_year: int
) -> DataFrame:
    """One row per region and day of the years, with its number of holidays."""
    spine = group_spine(
        states.select("regiao").distinct(), dt.date(first_year, 1, 1), dt.date(last_year, 12, 31)
    )
    return day_counts(spine, region_holiday_counts(holidays, states), ["regiao"])


def gold_rows(days: DataFrame, load_ts: dt.datetime) -> DataFrame:
    """Monthly rows of the regions that have a valid holiday in the year."""
    year = W.partitionBy("regiao", "ano")
    return (
        monthly_workdays(days, ["regiao"])
        .withColumn("_in_year", F.sum("total_feriados").over(year))
        .filter("_in_year > 0")
        .withColumn("dt_processamento", load_stamp(load_ts))
        .select(*GOLD.names)
    )


def _in_years(year: int, last_year: int | None) -> Column:
    return F.col("ano") == year if last_year is None else F.col("ano").between(year, last_year)


def silver_year(
    spark: SparkSession,
    silver_path: str,
    year: int,
    last_year: int | None = None,
    *,
    require_status: bool = False,
) -> DataFrame:
    """The newest state of each holiday of ``year``, or of the years to ``last_year``.

    The filter is on the partition column, so other years are not read. Rows that
    break a rule count too, unless ``require_status``.
    """
    silver = read_table(spark, silver_path, SILVER).filter(_in_years(year, last_year))
    newest = newest_state(silver)
    return newest.filter(F.col("status_processamento") == SUCCESS) if require_status else newest


def to_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    states: DataFrame,
    year: int,
    load_ts: dt.datetime,
    *,
    last_year: int | None = None,
    require_status: bool = False,
    views: bool = False,
    faults: DataFrame | None = None,
) -> DataFrame:
    """Refresh the monthly rows of the year, or of all years to ``last_year`` in one job;
    returns one metrics row per region and year.

    A region without valid holidays gets status ERRO and no rows; the others are
    written all the same. ``views`` also creates the session view of each region.
    ``faults`` (``region_faults``) names regions and years that cannot be computed: they get
    status ERRO and the fault's message, and what gold holds of them stays; the others go on.
    """
    if read_table(spark, silver_path, SILVER).isEmpty():
        raise ValueError("Nenhum registro em silver")
    holidays = silver_year(spark, silver_path, year, last_year, require_status=require_status)
    days = region_days(holidays, states, year, last_year or year)
    rows = gold_rows(days, load_ts)
    if faults is not None:
        faults = stage(faults, "gold-faults")
        rows = without_faults(rows, faults)
    upsert_table(
        rows,
        gold_path,
        GOLD,
        GOLD_KEY,
        GOLD_PARTITIONS,
        partitions_follow_keys=True,
    )
    # The metrics come from the rows just written, not from a second run of the plan.
    gold = read_table(spark, gold_path, GOLD)
    written = gold.filter(
        _in_years(year, last_year) & (F.col("dt_processamento") == load_stamp(load_ts))
    )
    regions = states.select("regiao").distinct()
    years = range(year, (last_year or year) + 1)
    if views:
        names = [row.regiao for row in regions.collect()]
        for each in years:
            create_views(gold, names, each)
    regions = regions.withColumn("ano", F.explode(F.sequence(F.lit(years[0]), F.lit(years[-1]))))
    totals = region_totals(written, groups=regions)
    return totals if faults is None else with_faults(totals, faults)


def touched_groups(
    spark: SparkSession, silver_path: str, states: DataFrame, changed: Sequence[Row], load_ts: dt.datetime
) -> DataFrame:
    """``(regiao, ano)``: the reports that the rows which the load at ``load_ts`` wrote to the
    partitions ``changed`` of silver can alter. A national holiday alters all regions."""
    years = sorted({part.ano for part in changed if part.ano is not None})
    months = sorted({part.mes for part in changed if part.ano is not None})
    written = read_table(spark, silver_path, SILVER).filter(
        F.col("ano").isin(years) & F.col("mes").isin(months) & (F.col("last_updated") == load_stamp(load_ts))
    )
    scopes = with_national(states).withColumnRenamed("uf", "estado")
    return written.select("ano", "estado").distinct().join(scopes, "estado").select("regiao", "ano").distinct()


def refresh_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    states: DataFrame,
    load_ts: dt.datetime,
    changed: Sequence[Row],
    *,
    newest_path: str | None = None,
) -> DataFrame:
    """Bring gold up to date after one load; returns one metrics row per region and year done.

    ``changed`` are the partitions of silver that the load changed (``load_silver``). Only
    the years of the regions that they concern are read, computed and replaced; the result is
    that of ``to_gold`` over all years. With ``newest_path`` the newest state of the holidays
    is read from the table that ``update_newest`` keeps, else it is found in silver's history.
    """
    pairs = stage(touched_groups(spark, silver_path, states, changed, load_ts), "gold-groups")
    years = sorted(row.ano for row in pairs.select("ano").distinct().collect())
    history = read_table(spark, silver_path if newest_path is None else newest_path, SILVER)
    holidays = history.filter(F.col("ano").isin(years))
    if newest_path is None:
        holidays = newest_state(holidays)
    # The spine is unfolded from the groups alone, so other regions and years cost nothing.
    groups = pairs.select("regiao", F.col("ano").alias("_ano"))
    spine = group_spine(groups, F.make_date("_ano", F.lit(1), F.lit(1)), F.make_date("_ano", F.lit(12), F.lit(31)))
    days = day_counts(spine.drop("_ano"), region_holiday_counts(holidays, states), ["regiao"])
    upsert_table(
        gold_rows(days, load_ts), gold_path, GOLD, GOLD_KEY, GOLD_PARTITIONS, partitions_follow_keys=True
    )
    written = read_table(spark, gold_path, GOLD).filter(
        F.col("ano").isin(years) & (F.col("dt_processamento") == load_stamp(load_ts))
    )
    return region_totals(written, groups=pairs)


def view_name(regiao: str, year: int) -> str:
    # Fixed value: the name users query a region's monthly rows by.
    return f"dias_uteis_{re.sub(r'[^0-9A-Za-z_]', '_', regiao)}_{year}"


def create_views(gold: DataFrame, regions: list[str], year: int) -> None:
    """One session view per region with its months in order."""
    for regiao in regions:
        (
            gold.filter((F.col("regiao") == regiao) & (F.col("ano") == year))
            .orderBy("mes")
            .createOrReplaceTempView(view_name(regiao, year))
        )


def create_report_function(gold: DataFrame, name: str = REPORT_FUNCTION) -> None:
    """A table function ``name(regiao, ano)`` of the session: the monthly rows of one report.

    It is the parameter form of the views: a query over many reports joins the function to
    a table of regions and years, and ``gold`` is scanned once, whatever their number.
    """
    spark = gold.sparkSession
    gold.createOrReplaceTempView(f"{name}_linhas")
    kinds = {f.name: f.dataType.simpleString() for f in gold.schema.fields}
    returned = ", ".join(f"`{c}` {kind}" for c, kind in kinds.items())
    columns = ", ".join(f"`{c}`" for c in kinds)
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(da_regiao {kinds["regiao"]}, do_ano {kinds["ano"]})
RETURNS TABLE ({returned})
RETURN SELECT {columns} FROM {name}_linhas WHERE regiao = da_regiao AND ano = do_ano"""
    )
