"""Holiday rules -> landing (JSON lines, one folder per load day)."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.calendar import expand_rules, merge_same_day, rule_conflicts, scopes_without_rules
from ..schemas import LANDING, SUCCESS, TIPO_NATIONAL, TIPO_STATE
from ..sinks import observed, write_json
from .metrics import LANDING_METRICS, one_row


def iso_millis(moment: dt.datetime) -> str:
    """ISO text in UTC with milliseconds; a time without a zone is taken as UTC."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return moment.isoformat(timespec="milliseconds") + "Z"


def landing_path(base_path: str, load_ts: dt.datetime) -> str:
    # Fixed value: the name of a load's folder.
    return f"{base_path}/holidays_{load_ts:%Y-%m-%d}.json"


def landing_rows(
    rules: DataFrame, first_year: int, last_year: int, load_ts: dt.datetime
) -> DataFrame:
    """One record per day and state, or per day for a national holiday."""
    stamp = F.lit(iso_millis(load_ts))
    holidays = merge_same_day(expand_rules(rules, first_year, last_year))
    return holidays.withColumns(
        {
            "data": F.col("data").cast("string"),
            "dt_processamento": stamp,
            "dt_carga": stamp,
        }
    ).select(*LANDING.names)


def extract(
    rules: DataFrame,
    first_year: int,
    last_year: int,
    base_path: str,
    load_ts: dt.datetime,
    *,
    scopes: DataFrame | None = None,
) -> DataFrame:
    """Write the calendar of the given years to landing; returns its metrics.

    ``scopes`` (``scope``) are those the calendar must cover: rules that leave one of them
    without any in a year, or contradict each other, are refused with an error.
    """
    started = time.perf_counter()
    if scopes is not None:
        gaps = scopes_without_rules(rules, scopes, first_year, last_year).groupBy("scope").agg(F.min("ano").alias("ano"))
        # An error names a few; it needs no complete list.
        found = [f"{r.scope} ({r.ano})" for r in gaps.orderBy("scope").limit(30).collect()]
        found += [f"{r.scope}: {r.nome} ({r.problem})" for r in rule_conflicts(rules).orderBy("scope", "nome").limit(30).collect()]
        if found:
            raise ValueError(f"Calendário incompleto: {', '.join(found)}")
    path = landing_path(base_path, load_ts)
    seen = Observation("landing")
    rows = landing_rows(rules, first_year, last_year, load_ts).observe(
        seen,
        F.count("*").alias("total_records"),
        F.count_if(F.col("tipo") == TIPO_NATIONAL).alias("national_holidays"),
        F.count_if(F.col("tipo") == TIPO_STATE).alias("state_holidays"),
    )
    write_json(rows, path)
    return one_row(
        rules.sparkSession,
        LANDING_METRICS,
        **{"total_records": 0, "national_holidays": 0, "state_holidays": 0} | observed(seen),
        status=SUCCESS,
        processing_time_seconds=time.perf_counter() - started,
        file_path=path,
        dt_carga=iso_millis(load_ts),
    )
