"""The whole chain as one call: each layer runs if the one before it passed."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import load_stamp
from ..operators.quality import HOLIDAY_RULES, Rule
from ..schemas import ERROR, FILE_PROCESSED, PARTIAL, SKIPPED, SUCCESS, columns
from ..scratch import stage
from ..sources import from_rows
from .bronze import to_bronze
from .gold import refresh_gold, to_gold
from .landing import extract, iso_millis, landing_path
from .newest import update_newest
from .report import COUNTS, layer_lines
from .silver import load_silver

LAYERS = ("landing", "bronze", "silver", "gold")

_LINES = columns(
    "camada string, item string, ano int, status string, "
    + ", ".join(f"{c} bigint" for c in COUNTS)
    + ", regions_processed bigint, processing_time_seconds double, error_message string"
)


class LakePaths(NamedTuple):
    """Where the tables of a lake lie."""

    landing: str
    bronze: str
    quarantine: str
    silver: str
    newest: str
    gold: str

    @classmethod
    def below(cls, base_path: str) -> LakePaths:
        return cls(*(f"{base_path}/{name}" for name in cls._fields))


def _gold_line(metrics: DataFrame) -> DataFrame:
    """One line for all regions: SUCESSO if every one is, PARCIAL if some are, else ERRO."""
    fine = F.count_if(F.col("processing_status") == SUCCESS)
    status = F.when(fine == F.count("*"), SUCCESS).when(fine > 0, PARTIAL).otherwise(ERROR)
    return metrics.agg(status.alias("status"), F.count_distinct("regiao").alias("regions_processed"))


def _whole(lines: DataFrame, seconds: float | None = None) -> DataFrame:
    """``lines`` with all columns of the report, absent ones NULL."""
    lines = lines.withColumn("processing_time_seconds", F.lit(seconds))
    return lines.select(
        *((F.col(f.name) if f.name in lines.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in _LINES)
    )


def run_lake(
    spark: SparkSession,
    rules: DataFrame,
    states: DataFrame,
    paths: LakePaths,
    load_ts: dt.datetime,
    first_year: int,
    last_year: int,
    *,
    checks: Sequence[Rule] = HOLIDAY_RULES,
    keep_first: Sequence[str | Column] | None = None,
    gold_after: Sequence[str] = (SUCCESS, PARTIAL),
    incremental: bool = False,
    every_state: bool = False,
) -> DataFrame:
    """Run landing, bronze, silver and gold for one load and report on all of them.

    A layer runs if the one before it passed: landing with SUCESSO, bronze with PROCESSED,
    silver with one of ``gold_after`` (marked rows stay in silver, so a run with some of them
    passes unless told otherwise). One that raises or fails gives a line with its message, and
    each layer behind it a line with status IGNORADO; the report itself is always returned.

    ``incremental`` computes only what the load changed in gold, from a table of newest
    states kept beside silver; otherwise all years from ``first_year`` to ``last_year``.

    ``every_state`` refuses rules that leave a state of ``states`` without any in one of the years.

    The report has a line per layer and one per region and year, with the counts of each,
    ``regions_processed``, ``processing_time_seconds``, ``error_message`` and the
    ``execution_date``, which is the load time given.
    """
    lines: list[DataFrame] = []
    changed: list = []
    passed = True

    def failed(layer: str, status: str, seconds: float | None = None, message: str | None = None) -> None:
        values = {"camada": layer, "item": "total", "status": status}
        values |= {"processing_time_seconds": seconds, "error_message": message}
        lines.append(from_rows(spark, [[values.get(name) for name in _LINES.names]], _LINES))

    def step(layer: str, run: Callable[[], DataFrame], passes: Sequence[str]) -> None:
        nonlocal passed
        if not passed:
            return failed(layer, SKIPPED)
        started = time.perf_counter()
        try:
            # Metrics are few rows; staged, they cost the layer's time and are not run again.
            metrics = stage(run(), f"{layer}-metrics")
            total = _gold_line(metrics) if layer == "gold" else metrics
            status = total.first().status
        except (PySparkException, Py4JError, ValueError) as error:
            passed = False
            return failed(layer, ERROR, time.perf_counter() - started, str(error))
        seconds = time.perf_counter() - started
        passed = status in passes
        if layer == "gold":
            head = total.withColumns({"camada": F.lit("gold"), "item": F.lit("total")})
            lines.append(_whole(head, seconds))
            lines.append(_whole(layer_lines(metrics, layer, ["error_message"])))
        else:
            said = [c for c in metrics.columns if c == "error_message"]
            lines.append(_whole(layer_lines(metrics, layer, said), seconds))

    def silver() -> DataFrame:
        metrics, parts = load_silver(
            spark, paths.bronze, paths.silver, load_ts, rules=checks, dt_carga=iso_millis(load_ts)
        )
        changed.extend(parts)
        return metrics

    def gold() -> DataFrame:
        if not incremental:
            return to_gold(spark, paths.silver, paths.gold, states, first_year, load_ts, last_year=last_year)
        update_newest(spark, paths.silver, paths.newest, load_ts, changed)
        return refresh_gold(
            spark, paths.silver, paths.gold, states, load_ts, changed, newest_path=paths.newest
        )

    scopes = states.select(F.col("uf").alias("scope")) if every_state else None
    step(
        "landing",
        lambda: extract(rules, first_year, last_year, paths.landing, load_ts, scopes=scopes),
        [SUCCESS],
    )
    file = landing_path(paths.landing, load_ts)
    step(
        "bronze",
        lambda: to_bronze(
            spark, file, paths.bronze, paths.quarantine, load_ts.date(), load_ts, keep_first=keep_first
        ),
        [FILE_PROCESSED],
    )
    step("silver", silver, gold_after)
    step("gold", gold, [SUCCESS, PARTIAL, ERROR])
    report = reduce(DataFrame.unionByName, lines)
    return report.withColumn("execution_date", load_stamp(load_ts))
